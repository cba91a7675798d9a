"""How filters interact: what each removes, alone and behind the others, in every order.

Each document gets one bit per filter that it fails. All counts follow from the
number of documents per part and bit mask, so the orders are evaluated on those
additive counts, never on documents.

The duplicate filter fails every document whose text a smaller id holds. A
counting Bloom sketch comes first: every text raises a few cells, each task adds up
its own and the sums are merged by cell. A text one of whose cells was raised once is
unique for certain. Only the others, the possible repeats, are shuffled by their
full text to find the smallest id. The sketch grows with the table (``CELLS_PER_TEXT``
cells for a document), so the share of false alarms does not.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.shared import require_columns, require_text
from foldwise.operators.lookup import attach, fit_lookup

CELLS_PER_TEXT = 16
RAISED = 4
BLOCK_CELLS = 4096
BLOCKS_PER_FILE = 256
MAX_FILTERS = 6

WHITE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Maximal runs of anything but space and the controls 9 to 13."""
    return F.array_remove(F.split(text, WHITE), "")


def share_above(part: Column, whole: Column, percent: int) -> Column:
    return 100 * part.cast("bigint") > percent * whole.cast("bigint")


def default_filters(text: str = "text") -> dict[str, Column]:
    """Failure conditions over a text without nulls, on columns that ``audit_filters`` offers: the text, ``words``."""
    words, body = F.col("words"), F.col(text)
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)).cast("bigint") < 80 * F.size(words).cast("bigint"),
        "C": share_above(F.octet_length(F.regexp_replace(body, "[^A-Z]+", "")), F.char_length(body), 10),
        "D": body.rlike("[#$%&*|]"),
    }


def _sketch_address(text: Column, blocks: int) -> tuple[Column, Column]:
    """Block and cells of a text; equal texts have equal ones."""
    h = F.xxhash64(text)
    g = F.xxhash64(h, F.lit(1))
    cells = F.array_distinct(F.array(*[
        F.pmod(F.shiftright(g, 16 * i), F.lit(BLOCK_CELLS)).cast("int") for i in range(RAISED)]))
    return F.pmod(h, F.lit(blocks)), cells


def crowded_cells(docs: DataFrame, text: str, blocks: int):
    """The merged sketch: for each block the cells that were raised more than once, as a measured lookup.

    Counts are added up in each task before they are shuffled, so a text that a
    third of all rows hold sends one count per cell and task.
    """
    block, cells = _sketch_address(F.coalesce(text, F.lit("")), blocks)
    raised = docs.select(block.alias("block"), F.explode(cells).alias("cell")).groupBy("block", "cell").agg(
        F.count(F.lit(1)).alias("n"))
    merged = raised.filter(F.col("n") > 1).groupBy("block").agg(
        F.collect_list("cell").alias("crowded"), F.max("n").alias("covered"))
    # a few hundred cells of a block are left: no more files than they need
    merged = merged.coalesce(max(1, blocks // BLOCKS_PER_FILE))
    return fit_lookup(merged, ["block"], ["crowded"], rows="covered")


def first_holders(docs: DataFrame, key: str, text: str):
    """For each text of several rows its smallest id, by the SHA-256 of the text, as a measured lookup.

    Texts that the sketch clears are not shuffled. Null is the empty text; null ids are no smallest ids.
    """
    blocks = max(1, -(-docs.count() * CELLS_PER_TEXT // BLOCK_CELLS))
    sketch = crowded_cells(docs, text, blocks)
    block, cells = _sketch_address(F.col("body"), blocks)
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.coalesce(text, F.lit("")).alias("body")).withColumns(
        {"block": block, "cells": cells})
    possible = attach(rows, sketch, ["block"]).filter(
        F.col("crowded").isNotNull() & F.forall("cells", lambda c: F.array_contains("crowded", c)))
    first = possible.groupBy("body").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    found = first.filter(F.col("copies") > 1).select(F.sha2("body", 256).alias("digest"), "first", "copies")
    return fit_lookup(found, ["digest"], ["first"], rows="copies")


def failure_masks(
    docs: DataFrame, failures: Mapping[str, Column], duplicate: str | None, key: str = "doc_id", text: str = "text",
    part: str | None = None,
) -> DataFrame:
    """Rows (id, part, mask): bit ``i`` of the mask is set where a document fails the i-th filter.

    ``failures`` are conditions over the column named ``text``, where null is
    the empty text, and ``words``, its words; a condition that is null counts as
    passed. ``duplicate`` names the filter, the last one, that fails a document whose text a
    smaller id holds; rows that share their id do not fail each other, and a null id neither fails nor makes others fail.
    """
    require_columns(docs, [key, *([part] if part else [])])
    require_text(docs, text)
    body = F.coalesce(F.col(text), F.lit(""))
    label = F.coalesce(F.col(part).cast("string"), F.lit("")) if part else F.lit("")
    rows = docs.select(F.col(key).cast("bigint").alias("__id"), label.alias("__part"), body.alias(text), words_of(body).alias("words"))
    mask = F.lit(0)
    for i, condition in enumerate(failures.values()):
        mask = mask + F.when(condition, 1 << i).otherwise(0)
    digest = [F.sha2(text, 256).alias("digest")] if duplicate else []
    rows = rows.select(F.col("__id").alias("id"), F.col("__part").alias("part"), mask.cast("int").alias("mask"), *digest)
    if not duplicate:
        return rows
    marked = attach(rows, first_holders(docs, key, text), ["digest"])
    again = F.when(F.col("id") > F.col("first"), 1 << len(failures)).otherwise(0)
    return marked.select("id", "part", (F.col("mask") + again).cast("int").alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame | None, label_key: str, lost: Mapping[str, Column]) -> DataFrame:
    """Rows (part, mask, n, one count per label condition). A document has a label if any row of ``labels`` of its id has it."""
    # equal rows are added up before the join, so that an id of many rows is one row there
    rows = masks.groupBy("id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    names = [f"lost{i}" for i in range(len(lost))]
    if labels is not None and lost:
        known = labels.select(F.col(label_key).cast("bigint").alias("label_id"), *[
            F.coalesce(c, F.lit(False)).cast("int").alias(n) for n, c in zip(names, lost.values())])
        known = known.filter(F.col("label_id").isNotNull()).groupBy("label_id").agg(
            *[F.max(n).alias(n) for n in names])
        rows = rows.join(known, F.col("id") == F.col("label_id"), "left")
    else:
        rows = rows.withColumns({n: F.lit(0) for n in names})
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[
        F.coalesce(F.sum(F.col("n") * F.col(c)), F.lit(0)).cast("bigint").alias(c) for c in names])


def audit_filters(
    docs: DataFrame, failures: Mapping[str, Column], duplicate: str | None = None, key: str = "doc_id", text: str = "text",
    part: str | None = None, labels: DataFrame | None = None, label_key: str = "doc_id", lost: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rows (part, filter_order, step, kept, removed, redundant, unique_fails, one column per ``lost``, shapley).

    There is one row for each part, each order of the filters and each step of it, zeros
    included; an empty table has no parts. At a step, ``removed`` counts the documents that its
    filter removes there, ``redundant`` those that fail it but are gone already,
    ``unique_fails`` those that fail no other filter, ``kept`` those left after it, a ``lost`` column
    the removed ones with that label, and ``shapley`` what the filter removes over all orders, at any step.
    """
    names = [*failures, *([duplicate] if duplicate else [])]
    if not 1 <= len(names) <= MAX_FILTERS or len(set(names)) != len(names):
        raise ValueError(f"1 to {MAX_FILTERS} filters of distinct names are needed")
    lost = dict(lost or {})
    counts = mask_counts(failure_masks(docs, failures, duplicate, key, text, part), labels, label_key, lost)
    steps = [
        {"o": "".join(order), "s": s + 1, "b": 1 << names.index(order[s]), "p": sum(1 << names.index(f) for f in order[:s])}
        for order in itertools.permutations(names) for s in range(len(names))]
    each = counts.withColumn("at", F.explode(F.from_json(F.lit(json.dumps(steps)), "array<struct<o:string,s:int,b:int,p:int>>")))
    fails = F.col("mask").bitwiseAND(F.col("at.b")) != 0
    open_still = F.col("mask").bitwiseAND(F.col("at.p")) == 0

    def total(condition: Column, of: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(of)).otherwise(0)).cast("bigint")

    audit = each.groupBy("part", F.col("at.o").alias("filter_order"), F.col("at.s").alias("step"), F.col("at.b").alias("bit")).agg(
        total(open_still & ~fails).alias("kept"), total(open_still & fails).alias("removed"),
        total(~open_still & fails).alias("redundant"), total(F.col("mask") == F.col("at.b")).alias("unique_fails"),
        *[total(open_still & fails, f"lost{i}").alias(n) for i, n in enumerate(lost)])
    over_orders = Window.partitionBy("part", "bit")  # as many rows as there are orders
    return audit.withColumn("shapley", F.sum("removed").over(over_orders)).drop("bit")
