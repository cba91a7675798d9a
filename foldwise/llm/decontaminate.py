"""Benchmark decontamination with DataFrame functions only.

A window is ``n`` words of a benchmark item in a row, or a whole item of fewer
words. Hashes of the windows form a set that is broadcast while it has at most
``BROADCAST_WINDOWS`` entries (a joined table beyond that). The hashes of all
token windows of the documents are looked up in it, hits are verified by
comparing the words, and the words they cover, or the documents, are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.shared import materialise, require_columns, require_text, row_key

BROADCAST_WINDOWS = 500_000
BROADCAST_HITS = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
FACTS = ("n_words", "n_hit", "items", "contaminated")


def _raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{BETWEEN}+"), "")


def _lower(word: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    ascii_only = F.octet_length(word) == F.char_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def words(text: Column) -> Column:
    """Lower-cased words: runs of a-z, 0-9 and characters beyond ASCII; none for null."""
    return F.transform(_raw_words(text), _lower)


def _window_hashes(hashes: Column, n: int) -> Column:
    """Structs (at, h) of all windows of n words, from an array of word hashes."""
    last = F.size(hashes) - F.lit(n)
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice(hashes, i + 1, n)).alias("h")))


def _word_hashes(text: Column) -> Column:
    return F.transform(_raw_words(text), lambda w: F.xxhash64(_lower(w)))


def benchmark_windows(items: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """Rows (h, n, window, items): each distinct window, its hash and the items that hold it."""
    split = items.select(F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("item"), words(F.col(text)).alias("w"))
    split = split.filter(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(n)))
    each = split.select("item", "n", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)).alias("i"))
    windows = each.select("item", "n", F.slice("w", F.col("i"), F.col("n")).alias("window"))
    return windows.groupBy("window", "n").agg(F.collect_set("item").alias("items")).select(
        F.xxhash64(F.transform("window", lambda w: F.xxhash64(w))).alias("h"), "n", "window", "items")


def _hits(docs: DataFrame, windows: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (did, th, hits) of documents with candidate windows; hits: structs (n, window, items, at)."""
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())  # at most n numbers
    count = windows.limit(BROADCAST_WINDOWS + 1).count()
    did, th = row_key(docs, key, text)
    scan = docs.select(did.alias("did"), th.alias("th"), _word_hashes(F.col(text)).alias("hashes"))
    parts = [_window_hashes(F.col("hashes"), n) for n in lengths]
    every = parts[0] if len(parts) == 1 else F.concat(*parts)
    at = scan.select("did", "th", F.inline(every))
    keys = windows.select("h").distinct()
    found = at.join(F.broadcast(keys) if count <= BROADCAST_WINDOWS else keys, "h")
    places = found.groupBy("did", "th", "h").agg(F.collect_list("at").alias("at"))
    known = places.join(F.broadcast(windows) if count <= BROADCAST_WINDOWS else windows, "h")
    return known.groupBy("did", "th").agg(F.collect_list(F.struct("n", "window", "items", "at")).alias("__hits"))


def _merged(intervals: Column) -> Column:
    """Sorted, disjoint [first, end) ranges of the covered words."""
    kind = "array<struct<s:int,e:int>>"

    def add(ranges: Column, x: Column) -> Column:
        last = F.element_at(ranges, -1)
        joined = F.concat(F.slice(ranges, 1, F.size(ranges) - 1), F.array(F.struct(
            last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))))
        return F.when((F.size(ranges) > 0) & (F.try_element_at(ranges, F.lit(-1))["e"] >= x["s"]), joined).otherwise(
            F.concat(ranges, F.array(x)))

    return F.aggregate(F.array_sort(intervals), F.array().cast(kind), add)


def find_contamination(
    docs: DataFrame, items: DataFrame, n: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Add n_words, n_hit, items (sorted ids as strings), contaminated and spans.

    ``spans`` are the ranges [s, e) of words inside a verified window. Null texts
    have no words; an item without words has no window; a null item id counts as
    'null'; a repeated item id as one item. Rows with equal keys and texts get
    the same result; null keys are allowed. Columns with the names of outputs
    are replaced. Without items every document is clean.
    """
    require_columns(docs, [key])
    require_columns(items, [item_key])
    require_text(docs, text)
    require_text(items, item_text)
    if n < 1:
        raise ValueError("n must be at least 1")
    windows = materialise(benchmark_windows(items, item_key, item_text, n))
    out = docs.drop(*FACTS, "spans")
    size = F.size(_raw_words(F.col(text))).cast("bigint")
    if windows.limit(1).count() == 0:
        return out.withColumns({
            "n_words": size, "n_hit": F.lit(0).cast("bigint"), "items": F.array().cast("array<string>"),
            "contaminated": F.lit(False), "spans": F.array().cast("array<struct<s:int,e:int>>")})
    hits = materialise(_hits(docs, windows, key, text))
    row = hits.agg(F.sum(F.size("__hits") * 64 + F.aggregate(
        "__hits", F.lit(0), lambda s, x: s + F.size(x["at"]) * 4 + F.size(x["items"]) * 16 + F.size(x["window"]) * 24
    ))).first()
    if (row[0] or 0) <= BROADCAST_HITS:
        hits = F.broadcast(hits)
    hits = hits.withColumnsRenamed({"did": "__did", "th": "__th"})
    did, th = row_key(docs, key, text)
    joined = out.join(hits, (did == F.col("__did")) & (th == F.col("__th")), "left")
    # words are split again only where a window may occur
    marked = joined.withColumn("__words", F.when(F.col("__hits").isNotNull(), words(F.col(text))))
    right = F.transform("__hits", lambda x: F.struct(
        x["n"].alias("n"), x["items"].alias("items"),
        F.filter(x["at"], lambda p: F.slice("__words", p + 1, x["n"]) == x["window"]).alias("at")))
    marked = marked.withColumn("__right", F.filter(right, lambda x: F.size(x["at"]) > 0))
    intervals = F.flatten(F.transform("__right", lambda x: F.transform(
        x["at"], lambda p: F.struct(p.alias("s"), (p + x["n"]).alias("e")))))
    none = F.array().cast("array<struct<s:int,e:int>>")
    spans = F.coalesce(F.when(F.col("__hits").isNotNull(), _merged(intervals)), none)
    found = F.array_sort(F.array_distinct(F.flatten(F.transform("__right", lambda x: x["items"]))))
    marked = marked.withColumns({
        "n_words": size, "spans": spans,
        "items": F.coalesce(F.when(F.col("__hits").isNotNull(), found), F.array().cast("array<string>"))})
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + (x["e"] - x["s"]))
    return marked.withColumn("n_hit", hit).withColumn("contaminated", F.col("n_hit") > 0).select(
        *out.columns, "n_words", "n_hit", "items", "contaminated", "spans")


def remove_contamination(
    docs: DataFrame, items: DataFrame, n: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", whole_documents: bool = False,
) -> DataFrame:
    """The documents without benchmark passages, in their own columns.

    By default the covered words go, each with what stands between it and the
    word before, and the rest of the text stays as it is. With
    ``whole_documents`` contaminated documents go.
    """
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"__own_{c}") for c in docs.columns])
    found = find_contamination(renamed, items, n, f"__own_{key}", f"__own_{text}", item_key, item_text)
    body = F.col(f"__own_{text}")
    if whole_documents:
        found = found.filter(~F.col("contaminated"))
    else:
        units = F.regexp_extract_all(body, F.lit(f"{BETWEEN}*{WORD}+"), F.lit(0))
        kept = F.filter(units, lambda u, i: ~F.exists("spans", lambda r: (i >= r["s"]) & (i < r["e"])))
        cut = F.concat(F.array_join(kept, ""), F.regexp_extract(body, f"{BETWEEN}*$", 0))
        found = found.withColumn(f"__own_{text}", F.when(F.col("contaminated"), cut).otherwise(body))
    return found.select(*[F.col(f"`__own_{c}`").alias(c) for c in docs.columns])
