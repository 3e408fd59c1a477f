"""Approximate findings of insecure calls by regular expressions, JVM-side.

A stand-in for a real scanner where none is there: calls are told apart by their text up to the next
semicolon, data flow and nesting are not seen, and a containment check anywhere in the file counts.
Findings are hints for triage; verdicts that drop rows come from `verify`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ARGS = r"\s*\([^;]*\+[^;]*\)"
_OPEN = r"\s*\(\s*[A-Za-z_$(]"

#: rule -> (category, pattern that must be found, pattern that must not).
RULES = {
    "sql_concatenated": ("CWE-89", r"\.\s*(?:executeQuery|executeUpdate|execute|addBatch|prepareStatement|prepareCall)" + _ARGS, None),
    "sql_not_literal": ("CWE-89", r"\.\s*(?:executeQuery|executeUpdate|execute|addBatch)" + _OPEN, None),
    "path_concatenated": ("CWE-22", r"(?:new\s+(?:File|FileInputStream|FileOutputStream|FileReader|FileWriter|RandomAccessFile)|Paths\s*\.\s*get|Path\s*\.\s*of|\.\s*getPath)" + _ARGS, None),
    "path_unchecked": ("CWE-22", r"(?:new\s+File|\.\s*resolve)\s*\((?:[^;()]*,)?\s*[A-Za-z_$(]", r"\.\s*(?:getCanonicalPath|getCanonicalFile|normalize|toRealPath)\s*\("),
    "command_string": ("CWE-78", r"\.\s*exec\s*\(\s*(?:\"|[A-Za-z_$(])[^,;]*\)", r"\.\s*exec\s*\(\s*new\s+String\s*\["),
    "command_shell": ("CWE-78", r"(?:new\s+ProcessBuilder\s*\(|new\s+String\s*\[\s*\]\s*\{)\s*\"(?:(?:/bin/)?(?:ba)?sh\"\s*,\s*\"-c|cmd(?:\.exe)?\"\s*,\s*\"/c)\"", None),
    "command_concatenated": ("CWE-78", r"(?:new\s+ProcessBuilder|\.\s*command)" + _ARGS, None),
}


def findings(code: Column, cwe: Column) -> Column:
    """The names of the rules of a category that fire on the code, in order."""
    fired = []
    for name, (category, found, missing) in RULES.items():
        hit = (cwe == category) & code.rlike(found)
        fired.append(F.when(hit & ~code.rlike(missing) if missing else hit, name))
    return F.array_compact(F.array(*fired))


def clean(code: Column, cwe: Column) -> Column:
    """Whether no rule fires; an approximation of the scanner's verdict."""
    return F.size(findings(code, cwe)) == 0
