"""Quality rules with cross-document line frequency.

A line is normalised (lower case, digits to 0, white space collapsed) and
hashed together with its host (here the ``source``).  The number of distinct
documents per (host, line) decides: a line found in more than
``max(min_docs, max_share * documents of the host)`` of them is boilerplate
and is removed; a document that loses more than ``max_removed`` of its words
is depleted and rejected.  Exact copies of a text count as one document, so a
text is never rejected for having been copied.

Defined cases: null text is an empty text (no words, fails the base rule);
null source is a host of its own; repeated rows are each judged and never add
up; a line in exactly the limit's number of documents stays; texts and lines of
any length are taken whole; an empty table gives an empty result; other columns
are ignored, or kept by ``clean``.  Line and text identities are 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import SPACE, let, materialize, text_of, words

SYMBOLS = "#*$%&|<>"
_KEY = ["doc_id", "host_key", "text_key"]


@dataclass(frozen=True)
class Limits:
    min_words: int = 50          # base rule: fewer words fail
    max_repeat_pct: int = 50     # base rule: share of words in repeated 3-word windows
    min_docs: int = 50           # a line in this many documents or fewer always stays
    max_share: float = 0.05      # ... or in this share of the host's documents
    max_removed: float = 0.5     # a document may lose this share of its words


def n_repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text."""
    def covered(pos: Column) -> Column:
        return F.aggregate(
            pos, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"])

    def repeated(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["p"]))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")))
    return F.when(F.size(w) < 4, F.lit(0)).otherwise(
        let(F.sort_array(windows), lambda s: let(repeated(s), covered)))


def line_key(line: Column, host_key: Column) -> Column:
    return F.xxhash64(host_key, line)


def _keyed(docs: DataFrame, host: str) -> DataFrame:
    t = text_of()
    return docs.select(
        F.col("doc_id"), t.alias("body"),
        F.xxhash64(F.coalesce(F.col(host).cast("string"), F.lit("\u0000"))).alias("host_key"),
        F.xxhash64(t, F.length(t)).alias("text_key"))


def normalised_lines(text: Column) -> Column:
    """Normalised lines in order; a line without a word is empty."""
    flat = F.regexp_replace(F.translate(F.lower(text), "123456789", "000000000"), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(F.split(flat, "\n"), lambda x: F.trim(x))


def heavy_lines(docs: DataFrame, limits: Limits, host: str = "source") -> tuple[DataFrame, DataFrame]:
    """``(heavy, found)``: boilerplate lines as (line, n_docs), and every place
    (doc key, line number, line, words) where a line stands that may be one.

    Two passes bound the shuffles: the first counts hashes only (combined
    before the shuffle); the second keeps the few lines over ``min_docs`` and
    counts their distinct documents exactly.
    """
    keyed = _keyed(docs, host)
    hashes = F.transform(F.filter(normalised_lines(F.col("body")), lambda x: x != ""),
                         lambda x: line_key(x, F.col("host_key")))
    often = materialize(
        keyed.select(F.explode(F.array_distinct(hashes)).alias("line"))
        .groupBy("line").agg(F.count("*").alias("rows")).where(F.col("rows") > limits.min_docs).select("line"))
    at = keyed.select(*_KEY, F.posexplode(normalised_lines(F.col("body"))).alias("line_no", "norm")).where("norm <> ''")
    found = materialize(
        at.select(*_KEY, "line_no", line_key(F.col("norm"), F.col("host_key")).alias("line"),
                  F.size(F.split(F.col("norm"), " ")).alias("words"))
        .join(often, "line").distinct())
    hosts = keyed.groupBy("host_key", "text_key").agg(F.lit(1)).groupBy("host_key").agg(F.count("*").alias("host_docs"))
    heavy = (
        found.select("host_key", "line", "text_key").distinct()
        .groupBy("host_key", "line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > limits.min_docs)
        .join(hosts, "host_key")
        .where(F.col("n_docs") > F.col("host_docs") * F.lit(limits.max_share))
        .select("line", "n_docs"))
    return materialize(heavy), found


def removals(docs: DataFrame, limits: Limits, host: str = "source") -> DataFrame:
    """Per document with boilerplate: its key, the removed lines and words."""
    heavy, found = heavy_lines(docs, limits, host)
    return (found.join(heavy.select("line"), "line")
            .groupBy(*_KEY).agg(F.count("*").alias("removed_lines"), F.sum("words").alias("removed_words"),
                                F.collect_set("line_no").alias("removed_at")))


def judge(docs: DataFrame, limits: Limits = Limits(), host: str = "source", gone: DataFrame | None = None) -> DataFrame:
    """One row per document: counts, ``base_failed``, what was removed, ``kept``.
    ``gone`` gives the :func:`removals` if they are known already."""
    removed = (removals(docs, limits, host) if gone is None else gone).select(*[F.col(c).alias(f"r_{c}") for c in _KEY], "removed_lines", "removed_words")
    lines = F.filter(F.split(F.col("body"), "\n"), lambda x: F.translate(x, SPACE, "") != "")
    counted = _keyed(docs, host).select(
        *_KEY,
        F.length(F.translate(F.col("body"), SPACE, "")).cast("long").alias("word_chars"),
        (F.length(F.col("body")) - F.length(F.translate(F.col("body"), SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(words(F.col("body")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), n_repeat_words(w).cast("long").alias("n_repeat_words"))).alias("w"))
    judged = counted.select(
        *_KEY, "word_chars", "n_symbols", "n_dup_lines", "w.n_words", "w.n_repeat_words",
        ((F.col("w.n_words") < limits.min_words)
         | (F.col("w.n_repeat_words") * 100 > F.col("w.n_words") * limits.max_repeat_pct)).alias("base_failed"))
    same = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in _KEY]
    lost = F.coalesce(F.col("removed_words"), F.lit(0)).cast("long")
    depleted = lost > F.col("n_words") * F.lit(limits.max_removed)
    return judged.join(removed, same[0] & same[1] & same[2], "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.coalesce(F.col("removed_lines"), F.lit(0)).cast("long").alias("removed_lines"), lost.alias("removed_words"),
        depleted.alias("depleted"), (~F.col("base_failed") & ~depleted).alias("kept"), *_KEY[1:])


def clean(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """The documents that are kept, with their boilerplate lines cut out.

    Columns are those of ``docs``; ``n_chars`` follows the new text where it
    exists.  A text without boilerplate is returned unchanged.
    """
    gone = materialize(removals(docs, limits, host))   # lines are counted once, for the cut and for the verdict
    cut = gone.select(*[F.col(c).alias(f"r_{c}") for c in _KEY], "removed_at")
    keep = judge(docs, limits, host, gone).where("kept").select(*[F.col(c).alias(f"k_{c}") for c in _KEY]).distinct()
    verdict = materialize(keep.join(
        cut, F.col("k_doc_id").eqNullSafe(F.col("r_doc_id")) & (F.col("k_host_key") == F.col("r_host_key"))
        & (F.col("k_text_key") == F.col("r_text_key")), "left").select("k_doc_id", "k_host_key", "k_text_key", "removed_at"))
    t = text_of()
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("d"),
        F.xxhash64(F.coalesce(F.col(host).cast("string"), F.lit("\u0000"))).alias("h"), F.xxhash64(t, F.length(t)).alias("k"))
    joined = rows.join(verdict, F.col("d").eqNullSafe(F.col("k_doc_id")) & (F.col("h") == F.col("k_host_key"))
                       & (F.col("k") == F.col("k_text_key")))
    text = F.col("row.text")
    new = F.when(F.col("removed_at").isNull(), text).otherwise(
        F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.col("removed_at"), i)), "\n"))
    out = [new.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        size = F.when(F.col("removed_at").isNull(), F.col("row.n_chars")).otherwise(F.length(new)).cast(kind)
        out[docs.columns.index("n_chars")] = size.alias("n_chars")
    return joined.select(*out)
