"""Small self-contained pairs for dry runs, and a generator that emits them without a model."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaloom import config as c

_CLASS = "public class @name@ {\n    @method@\n}\n"

#: Category -> vulnerable and fixed method; @name@ and @word@ vary.
METHODS = {
    "CWE-89": (
        'public java.sql.ResultSet find(java.sql.Connection db, String key) throws java.sql.SQLException {\n        return db.createStatement().executeQuery("SELECT id FROM @word@ WHERE name = \'" + key + "\'");\n    }',
        'public java.sql.ResultSet find(java.sql.Connection db, String key) throws java.sql.SQLException {\n        java.sql.PreparedStatement query = db.prepareStatement("SELECT id FROM @word@ WHERE name = ?");\n        query.setString(1, key);\n        return query.executeQuery();\n    }',
    ),
    "CWE-22": (
        'public byte[] load(String file) throws java.io.IOException {\n        return java.nio.file.Files.readAllBytes(java.nio.file.Paths.get("/data/@word@/" + file));\n    }',
        'public byte[] load(String file) throws java.io.IOException {\n        java.nio.file.Path root = java.nio.file.Paths.get("/data/@word@").toAbsolutePath().normalize();\n        java.nio.file.Path path = root.resolve(file).normalize();\n        if (!path.startsWith(root)) {\n            throw new java.io.IOException("outside of " + root);\n        }\n        return java.nio.file.Files.readAllBytes(path);\n    }',
    ),
    "CWE-78": (
        'public Process start(String target) throws java.io.IOException {\n        return Runtime.getRuntime().exec("@word@ " + target);\n    }',
        'public Process start(String target) throws java.io.IOException {\n        if (!target.matches("[a-z0-9.-]+")) {\n            throw new IllegalArgumentException(target);\n        }\n        return new ProcessBuilder("@word@", target).start();\n    }',
    ),
}
WORDS = {
    "CWE-89": ("accounts", "parcels", "tickets", "members", "lessons", "sensors"),
    "CWE-22": ("photos", "drafts", "exports", "scans", "plans", "letters"),
    "CWE-78": ("ping", "host", "dig", "whois", "tracepath", "nslookup"),
}


def _filled(method: str, name: str, word: str) -> str:
    return _CLASS.replace("@method@", method).replace("@name@", name).replace("@word@", word)


def pairs(spark: SparkSession) -> DataFrame:
    """Eighteen pairs, six of each category, and a copy of the first."""
    rows = []
    for cwe, (bad, good) in METHODS.items():
        for word in WORDS[cwe]:
            name = f"{word.capitalize()}Service"
            rows.append((_filled(bad, name, word), _filled(good, name, word), cwe))
    rows.append(rows[0])
    return spark.createDataFrame([(*r, f"demo:{i}", "fix", i) for i, r in enumerate(rows)], "vulnerable_code string, fixed_code string, cwe string, source_id string, kind string, ord long")


@dataclass(frozen=True)
class DemoClient:
    """Answers each attempt with a numbered variant of its category's pair, as JSON."""

    name: str = "mock"

    def responses(self, attempts: DataFrame) -> DataFrame:
        texts = {cwe: json.dumps(dict(zip(("vulnerable_code", "fixed_code"), (_filled(m, "Generated@n@", "table@n@") for m in both), strict=True))) for cwe, both in METHODS.items()}
        made = F.element_at(F.create_map(*(F.lit(x) for kv in texts.items() for x in kv)), F.col("cwe"))
        return attempts.withColumn("response", F.replace(made, F.lit("@n@"), F.col("attempt").cast("string")))


assert set(METHODS) == set(c.TARGET_CWES)
