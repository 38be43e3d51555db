"""Text and coercion expressions; all stay inside the JVM."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode blanks, with the separators U+001C to U+001F.
BLANK = r"(?U)[\s\x1c-\x1f]"


def collapse(col: Column) -> Column:
    """Runs of blanks become one space, ends are trimmed; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(col, F.lit("")), BLANK + "+", " "))


def normalized_text(col: Column) -> Column:
    return F.lower(collapse(col))


def unicode_regex(pattern: str) -> str:
    """A case-insensitive pattern with Unicode classes and word bounds."""
    return "(?iU)" + pattern


def matches(text: Column, pattern: str) -> Column:
    """Whether the case-insensitive pattern occurs; texts of single-byte signs take the cheaper ASCII classes, which agree there."""
    return F.when(F.octet_length(text) == F.length(text), text.rlike("(?i)" + pattern)).otherwise(text.rlike(unicode_regex(pattern)))


def to_long(col: Column) -> Column:
    """'' and unreadable text are null; decimals are cut towards zero; infinities are null."""
    text = F.trim(col.cast("string"))
    double = text.try_cast("double")
    cut = F.when(~F.isnan(double) & (F.abs(double) < F.lit(9.2e18)), double.cast("long"))
    return F.coalesce(text.try_cast("long"), cut)


def to_double(col: Column) -> Column:
    return F.trim(col.cast("string")).try_cast("double")


def iso_seconds(text: str) -> float:
    """Epoch seconds of an ISO date or time; one without a zone is UTC."""
    moment = datetime.fromisoformat(text)
    return (moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)).timestamp()


def sentences(text: Column) -> Column:
    """Sentences of the collapsed text, cut after . ! ? and a blank."""
    return F.filter(F.split(collapse(text), r"(?<=[.!?]) +"), lambda s: s != "")


def full_name(col: Column) -> tuple[Column, Column]:
    """(kind, id): ``t1_abc`` is (t1, abc); without a kind the text itself is the id."""
    kind, bare = F.regexp_extract(col, r"(?s)^(t\d)_(.+)$", 1), F.regexp_extract(col, r"(?s)^(t\d)_(.+)$", 2)
    return F.when(bare != "", kind), F.when(bare != "", bare).otherwise(col)


def truthy(col: Column) -> Column:
    """Null for '' as well."""
    return F.nullif(col, F.lit(""))


def distinct_ci(items: Column) -> Column:
    """First-seen distinct elements, ignoring case and blanks at the ends."""
    cleaned = F.filter(F.transform(items, collapse), lambda x: x != "")
    return F.aggregate(
        cleaned,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.array_append(acc, x)),
    )


def occurrences(text: Column, pattern: str, group: int) -> Column:
    """All hits of the case-insensitive pattern by position; texts of single-byte signs take the cheaper ASCII classes."""
    plain = F.octet_length(text) == F.length(text)
    each = lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(group))
    return F.when(plain, each("(?i)" + pattern)).otherwise(each(unicode_regex(pattern)))


PASSAGE, LEAST = 320, 24


def _pack_sentences(paragraph: Column, limit: int, least: int) -> Column:
    """Greedy packing of a long paragraph's sentences.

    The running size counts a blank after each sentence, except after the
    first one that follows a full passage.
    """
    sentences = F.filter(F.transform(F.split(paragraph, r"(?U)(?<=[.!?])[\s\x1c-\x1f]+"), collapse), lambda s: s != "")
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("size"))

    def step(acc: Column, s: Column) -> Column:
        full = (acc["size"] + F.length(s) + 1 > limit) & (acc["open"] != "")
        kept = F.when(F.length(acc["open"]) >= least, F.array_append(acc["done"], acc["open"])).otherwise(acc["done"])
        return F.struct(
            F.when(full, kept).otherwise(acc["done"]).alias("done"),
            F.when(full | (acc["open"] == ""), s).otherwise(F.concat(acc["open"], F.lit(" "), s)).alias("open"),
            F.when(full, F.length(s)).otherwise(acc["size"] + F.length(s) + 1).alias("size"),
        )

    return F.aggregate(sentences, state, step, lambda acc: F.when(F.length(acc["open"]) >= least, F.array_append(acc["done"], acc["open"])).otherwise(acc["done"]))


def passages(text: Column, limit: int = PASSAGE, least: int = LEAST) -> Column:
    """Array of passages: paragraphs at blank lines; long ones packed from sentences."""
    lines = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n")
    paragraphs = F.filter(F.transform(F.split(lines, r"\n{2,}"), collapse), lambda p: p != "")
    return F.flatten(F.transform(paragraphs, lambda p: F.when(F.length(p) <= limit, F.array(p)).otherwise(_pack_sentences(p, limit, least))))
