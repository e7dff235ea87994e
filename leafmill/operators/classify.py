"""Rule-driven classification: file-name globs first, then the category with most keyword hits, then the default."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import let

#: Characters of title and body that are looked at.
TEXT_LENGTH = 4000


@dataclass(frozen=True)
class Config:
    """taxonomy, default category, ordered mapping glob -> category, ordered keywords category -> list (repeats count twice)."""

    taxonomy: tuple[str, ...] = ()
    default_category: str = "unclassified"
    mapping: dict[str, str] = field(default_factory=dict)
    keywords: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | None) -> Config:
        """From YAML; no path, a missing file or broken YAML gives the defaults."""
        import yaml

        try:
            with open(path or "", encoding="utf-8") as f:
                raw = yaml.safe_load(f) or {}
        except (OSError, yaml.YAMLError):
            return cls()
        if not isinstance(raw, dict):
            return cls()
        return cls(tuple(map(str, raw.get("taxonomy") or ())), str(raw.get("default_category") or "unclassified"), {str(k): str(v) for k, v in (raw.get("mapping") or {}).items()}, {str(k): tuple(map(str, v or ())) for k, v in (raw.get("keywords") or {}).items()})

    def categories(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((*self.taxonomy, self.default_category)))

    def warnings(self) -> list[tuple[str, str]]:
        """(kind, category) of rules that name a category outside the taxonomy."""
        known = set(self.categories())
        return [(k, c) for k, cs in (("mapping", self.mapping.values()), ("keywords", self.keywords)) for c in cs if c not in known]


def glob_pattern(glob: str) -> str:
    """Anchored pattern of a file-name glob: * ? [..] [!..]; everything else is literal."""
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        i += 1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[" and (end := glob.find("]", i + 1)) > 0:
            inner = glob[i:end].replace("\\", "\\\\")
            i = end + 1
            out.append("[" + ("^" + inner[1:] if inner[:1] == "!" else inner) + "]")
        else:
            out.append(re.escape(c) if c not in "/-_ " else c)
    return r"(?s)\A" + "".join(out) + r"\z"


def by_mapping(config: Config, name: Column) -> Column:
    """Category of the first glob that matches the name as it is or, both in small letters, else null."""
    out = F.lit(None).cast("string")
    for glob, category in reversed(config.mapping.items()):
        hit = name.rlike(glob_pattern(glob)) | F.lower(name).rlike(glob_pattern(glob.lower()))
        out = F.when(hit, F.lit(category)).otherwise(out)
    return out


def by_keywords(config: Config, text: Column) -> Column:
    """Category with most keywords contained in the text; the first of equals; null without a hit."""
    if not config.keywords:
        return F.lit(None).cast("string")

    def best(low: Column) -> Column:
        count = lambda ks: F.size(F.filter(F.array(*[F.lit(k.lower()) for k in ks]), lambda k: F.contains(low, k))) if ks else F.lit(0)
        # the greatest struct has most hits and, of equals, comes first
        return F.array_max(F.array(*[F.struct(count(ks).alias("n"), F.lit(-i).alias("first"), F.lit(c).alias("category")) for i, (c, ks) in enumerate(config.keywords.items())]))

    return let(F.lower(text), lambda low: let(best(low), lambda b: F.when(b["n"] > 0, b["category"])))


def classify(config: Config, name: Column, text: Column) -> Column:
    return F.coalesce(by_mapping(config, name), by_keywords(config, F.concat(name, F.lit("\n"), text)), F.lit(config.default_category))


def valid_category(config: Config, category: Column) -> Column:
    """The category, or the default where it is none of the taxonomy."""
    return F.when(category.isin(*config.categories()), category).otherwise(F.lit(config.default_category))


def classify_text(title: Column, body: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.substring(F.coalesce(body, F.lit("")), 1, TEXT_LENGTH))


def reclassified(config: Config, manifest: DataFrame) -> DataFrame:
    """(relpath, old_category, new_category) of kept documents whose category a changed configuration moves."""
    new = valid_category(config, classify(config, F.regexp_extract("relpath", r"([^/]*)\z", 1), F.col("classify_text")))
    return manifest.withColumn("new_category", new).where(~F.col("new_category").eqNullSafe(F.col("category"))).select("relpath", F.col("category").alias("old_category"), "new_category")
