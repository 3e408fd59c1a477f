"""Text expressions, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curaloom import config as c


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(c.SPACES))


def rstrip(x: Column) -> Column:
    return F.rtrim(x, F.lit(c.SPACES))


def collapsed(x: Column) -> Column:
    """White space runs as one space, ends stripped."""
    return F.trim(F.regexp_replace(x, c.SPACE_CLASS + "+", " "))


def fingerprint(*texts: Column) -> Column:
    """SHA-256 of the collapsed texts with NUL between them."""
    return F.sha2(F.concat_ws("\0", *(collapsed(t) for t in texts)), 256)


def bound(value: Column, body) -> Column:
    """body(value) with value computed once, also where the optimizer merges projections."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def tokens(x: Column) -> Column:
    return F.regexp_extract_all(F.lower(x), F.lit(c.WORD_CLASS + "+"), F.lit(0))


def shingles(x: Column, width: int = 4) -> Column:
    """Distinct runs of width tokens joined by spaces; fewer tokens are one run, so the set is never empty."""

    def runs(t: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.size(t) - (width - 1)), lambda i: F.array_join(F.slice(t, i, width), " "))
        return F.array_distinct(F.when(F.size(t) < width, F.array(F.array_join(t, " "))).otherwise(many))

    return bound(tokens(x), runs)


def shingle_hashes(x: Column, width: int = 4) -> Column:
    """64-bit hashes of the distinct shingles."""

    def runs(t: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.size(t) - (width - 1)), lambda i: F.xxhash64(F.slice(t, i, width)))
        return F.array_distinct(F.when(F.size(t) < width, F.array(F.xxhash64(t))).otherwise(many))

    return bound(tokens(x), runs)


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two nonempty sets."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def _folded(digits: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in c.CWE_FOLD.items() for x in kv)), F.nullif(digits, F.lit("")))


def cwe_label(raw: Column) -> Column:
    """The target category of the first number in raw, child categories folded; null when out of scope."""
    return _folded(F.regexp_extract(raw.cast("string"), "([0-9]+)", 1))


def cwe_mentioned(raw: Column) -> Column:
    """The target category of the first number in scope; null when there is none."""
    found = F.transform(F.regexp_extract_all(raw.cast("string"), F.lit("[0-9]+"), F.lit(0)), lambda d: _folded(d))
    return F.try_element_at(F.filter(found, lambda x: x.isNotNull()), F.lit(1))


def cwe_strict(raw: Column) -> Column:
    """CWE-n of the first number; an error unless it is a target itself (child categories are not folded)."""
    name = F.concat(F.lit("CWE-"), F.regexp_extract(F.coalesce(raw.cast("string"), F.lit("")), "([0-9]+)", 1))
    return F.when(name.isin(*c.TARGET_CWES), name).otherwise(F.raise_error(F.concat(F.lit("unsupported CWE: "), F.coalesce(raw.cast("string"), F.lit("null")))))


def user_prompt(code: Column, cwe: Column) -> Column:
    """The prompt for a piece of code; null for an unknown category."""
    a, b, d, e = (F.lit(p) for p in c.PROMPT_PARTS)
    described = F.element_at(F.create_map(*(F.lit(x) for kv in c.CWE_DESCRIPTIONS.items() for x in kv)), cwe)
    return F.concat(a, cwe, b, described, d, rstrip(code), e)


def fenced(code: Column) -> Column:
    return F.concat(F.lit("```java\n"), rstrip(code), F.lit("\n```"))


def prompt_chars(code: Column, cwe: Column, fixed: Column) -> Column:
    """Characters of the system prompt, the user prompt and the fixed code together."""
    return F.lit(len(c.SYSTEM_PROMPT)) + F.length(user_prompt(code, cwe)) + F.length(fixed)


# The shapes of a fenced block and of a type declaration.
_S, _NAME = c.SPACE_CLASS, r"[A-Za-z_$](?:[\p{L}\p{N}_]|\$)*"
_FENCE = r"(?s)```(?:[Jj]ava)?[ \t]*\n(.*?)```"
_DECLARES = rf"(?U)\b(?:class|interface|enum|record){_S}+{_NAME}"
_PUBLIC = rf"(?U)\bpublic{_S}+(?:(?:final|abstract|strictfp){_S}+)*(?:class|interface|enum|record){_S}+({_NAME})"
_ANY = rf"(?U)\b(?:class|interface|enum|record){_S}+({_NAME})"


def java_code(response: Column) -> Column:
    """The first fenced block that declares a type, else the whole text if it declares one and has no fence; else null."""
    blocks = F.filter(F.regexp_extract_all(response, F.lit(_FENCE), F.lit(1)), lambda b: b.rlike(_DECLARES))
    whole = F.when(response.rlike(_DECLARES) & ~response.contains("```"), response)
    return strip(F.coalesce(F.try_element_at(blocks, F.lit(1)), whole))


def main_type(code: Column) -> Column:
    """The public type's name, else the first type's, else Snippet."""
    named = lambda p: F.nullif(F.regexp_extract(code, p, 1), F.lit(""))
    return F.coalesce(named(_PUBLIC), named(_ANY), F.lit("Snippet"))


def json_pair(response: Column) -> Column:
    """struct(vulnerable_code, fixed_code) from the outermost braces of a response; null unless both are nonempty strings."""
    bare = F.regexp_replace(response, "```(?:json)?", "")
    begin, length = F.locate("{", bare), F.length(bare)
    end = length - F.locate("}", F.reverse(bare)) + 1
    body = F.when((begin > 0) & (F.locate("}", bare) > 0) & (end > begin), F.substring(bare, begin, end - begin + 1))
    value = F.try_parse_json(body)
    text = lambda k: F.when(F.schema_of_variant(F.try_variant_get(value, f"$.{k}", "variant")) == "STRING", F.nullif(F.try_variant_get(value, f"$.{k}", "string"), F.lit("")))
    v, f = text("vulnerable_code"), text("fixed_code")
    return F.when(v.isNotNull() & f.isNotNull(), F.struct(v.alias("vulnerable_code"), f.alias("fixed_code")))


def rate_cell(passed: Column, total: Column) -> Column:
    """'96% (96/100)', halves to even; 'n/a (tool missing)' where nothing was evaluated."""
    percent = F.bround(passed * 100 / total, 0).cast("long").cast("string")
    shown = F.concat(percent, F.lit("% ("), passed.cast("string"), F.lit("/"), total.cast("string"), F.lit(")"))
    return F.when(F.coalesce(total, F.lit(0)) > 0, shown).otherwise("n/a (tool missing)")


def floor_percent(passed: Column, total: Column) -> Column:
    """The scorecard's percentage, rounded down."""
    return F.when(total > 0, F.concat(F.floor(passed * 100 / total).cast("string"), F.lit("%")))


def chat_example(system: Column, user: Column, output: Column) -> tuple[Column, Column]:
    """prompt and completion as arrays of role and content."""
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(turn("system", system), turn("user", user)).alias("prompt"), F.array(turn("assistant", output)).alias("completion")
