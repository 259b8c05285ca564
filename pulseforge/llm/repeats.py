"""Exact removal of repeated passages: seed and extend.

Every window of ``min_words`` words has one anchor, the run of ``GRAM`` words in
it with the least hash (winnowing), chosen by the window's words alone. So equal
windows have equal anchors, and only windows whose anchor occurs again can
repeat. The job

1. lists each document's anchors and keeps those that occur more than once;
2. takes, for each kept anchor, the windows around it that have this anchor, each
   as a hash of its words;
3. brings the cuts of one anchor together and extends: which of their windows
   are equal to another's. Runs of such windows are the maximal repeats;
4. takes the words of all runs out of the documents.

Nothing is done by pairs: an anchor's cuts are compared by the hashes of their
windows. An anchor with very many cuts is dealt over several tasks; each settles
the windows that repeat within its share and passes on one of each kind, and the
kinds are counted across shares. Rows equal in id and text are cut once and count
as often as they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseforge.llm.common import Words, blocks, mix, written

MIN_WORDS = 35
GRAM = 8
#: Cuts of one anchor that one task holds.
SHARE = 4_000
_SLICE = 1 << 18


def _keyed(docs: DataFrame) -> DataFrame:
    """A document is known by its id and its text's hash; rows equal in both have
    equal results."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"), F.xxhash64(text).alias("_th"), text.alias("text"))


def owners(words: Words, min_words: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that lie in one text, the anchor of each (the word it begins at),
    and the hashes of all anchors. Of equal hashes the last counts."""
    grams = words.grams(gram)
    window = np.flatnonzero(words.whole(min_words))
    span = min_words - gram + 1
    anchor = np.empty(len(window), dtype=np.int64)
    if len(window):
        view = np.lib.stride_tricks.sliding_window_view(grams, span)
        for at in range(0, len(window), _SLICE):
            some = window[at:at + _SLICE]
            low, high = some[0], some[-1] + 1
            best = view[low:high, ::-1].argmin(axis=1)[some - low]
            anchor[at:at + _SLICE] = some + (span - 1) - best
    return window, anchor, grams


def _anchors(docs: DataFrame, min_words: int, gram: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in blocks(batches, "text"):
            words = Words(column)
            _, anchor, grams = owners(words, min_words, gram)
            anchor = np.unique(anchor)
            doc = words.text_of()[anchor] if len(anchor) else anchor
            ids, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            yield pa.record_batch({
                "anchor": pa.array(grams[anchor].view(np.int64)), "_id": pa.array(ids[doc]), "_th": pa.array(hashes[doc]),
                "position": pa.array((anchor - words.doc[doc]).astype(np.int32)),
            })

    return docs.mapInArrow(find, "anchor long, _id long, _th long, position int")


def _cuts(docs: DataFrame, min_words: int, gram: int) -> DataFrame:
    """``docs`` with ``rows`` and ``marks`` -> the windows of each marked anchor: the
    word the first begins at (``low``), and the hash of each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in blocks(batches, "text"):
            words = Words(column)
            window, anchor, grams = owners(words, min_words, gram)
            marks = batch.column(batch.schema.get_field_index("marks"))
            doc = np.repeat(np.arange(len(column)), marks.value_lengths().to_numpy())
            flat = marks.flatten()
            position = flat.field("position").to_numpy(zero_copy_only=False) + words.doc[doc]
            parts = flat.field("parts").to_numpy(zero_copy_only=False)
            position, first_of = np.unique(position, return_index=True)
            doc, parts = doc[first_of], parts[first_of]
            # Windows of one anchor follow one another.
            first = np.searchsorted(anchor, position, side="left")
            many = np.searchsorted(anchor, position, side="right") - first
            ends = np.append(0, np.cumsum(many))
            at = np.arange(ends[-1]) + np.repeat(first - ends[:-1], many)
            hashes_ = words.grams(min_words)[window[at]]
            low = window[first] - words.doc[doc]
            ids, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            # The same share again if the task is run again, and even for every anchor.
            share = mix(ids[doc].view(np.uint64) ^ mix(hashes[doc].view(np.uint64) ^ mix(low.astype(np.uint64)))) % parts.astype(np.uint64)
            yield pa.record_batch({
                "anchor": pa.array(grams[position].view(np.int64)), "share": pa.array(share.astype(np.int32)), "parts": pa.array(parts.astype(np.int32)),
                "_id": pa.array(ids[doc]), "_th": pa.array(hashes[doc]), "low": pa.array(low.astype(np.int32)),
                "rows": pa.array(batch.column(batch.schema.get_field_index("rows")).to_numpy()[doc]),
                "windows": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(hashes_.view(np.int64))),
            })

    return docs.mapInArrow(cut, "anchor long, share int, parts int, _id long, _th long, low int, rows long, windows array<long>")


_FOUND = "_id long, _th long, low int, high int, anchor long, window long, rows long"


def _groups(batches: Iterator[pa.RecordBatch], limit: int = 5_000) -> Iterator[pa.Table]:
    """Batches sorted by anchor and share -> tables of whole groups."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        a, s = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if waiting:
            end = waiting[-1]
            old = (end.column(0)[-1].as_py(), end.column(1)[-1].as_py())
            same = int(np.argmin(np.append((a == old[0]) & (s == old[1]), False)))
            if same:
                waiting.append(batch.slice(0, same))
                batch, a, s = batch.slice(same), a[same:], s[same:]
            if batch.num_rows:
                yield pa.Table.from_batches(waiting)
                waiting = []
        while batch.num_rows:
            # Whole groups up to the limit; the last group may go on.
            new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (s[1:] != s[:-1])))
            if len(new) == 1:
                waiting = [batch]
                break
            to = int(new[max(1, min(len(new) - 1, int(np.searchsorted(new, limit))))])
            yield pa.Table.from_batches([batch.slice(0, to)])
            batch, a, s = batch.slice(to), a[to:], s[to:]
    if waiting:
        yield pa.Table.from_batches(waiting)


def _extend(cuts: DataFrame, min_words: int) -> DataFrame:
    """Runs of repeated windows; of anchors in several shares also one window of
    each kind that stands once or more in the share (``high`` null)."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            lists = table["windows"].combine_chunks()
            sizes = lists.value_lengths().to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            hashes = lists.flatten().to_numpy()
            anchor, share = table["anchor"].to_numpy(), table["share"].to_numpy()
            group = np.cumsum(np.append(False, (anchor[1:] != anchor[:-1]) | (share[1:] != share[:-1])))
            order = np.lexsort((hashes, group[row]))
            g, h = group[row][order], hashes[order]
            equal = (g[1:] == g[:-1]) & (h[1:] == h[:-1])
            again = np.zeros(len(order), dtype=bool)
            again[order] = np.append(equal, False) | np.append(False, equal)
            many = table["rows"].to_numpy()
            again |= many[row] > 1
            ids, texts, low = table["_id"].to_numpy(), table["_th"].to_numpy(), table["low"].to_numpy()
            place = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            # Repeated windows one after another in a cut make one run.
            hit = np.flatnonzero(again)
            if len(hit):
                new = np.flatnonzero(np.append(True, (row[hit][1:] != row[hit][:-1]) | (place[hit][1:] != place[hit][:-1] + 1)))
                start, stop = hit[new], hit[np.append(new[1:], len(hit)) - 1]
                yield _found(ids[row[start]], texts[row[start]], place[start], place[stop] + min_words, None, None, None)
            kinds = order[np.append(True, ~equal)] if len(order) else order
            kinds = kinds[table["parts"].to_numpy()[row[kinds]] > 1]
            if len(kinds):
                yield _found(ids[row[kinds]], texts[row[kinds]], place[kinds], None, anchor[row[kinds]], hashes[kinds], many[row[kinds]])

    rows = cuts.repartition("anchor", "share").sortWithinPartitions("anchor", "share")
    return rows.mapInArrow(extend, _FOUND)


def _found(ids, texts, low, high, anchor, window, rows) -> pa.RecordBatch:
    n = len(ids)
    column = lambda values, kind: pa.nulls(n, kind) if values is None else pa.array(np.asarray(values), kind)
    return pa.record_batch({
        "_id": column(ids, pa.int64()), "_th": column(texts, pa.int64()), "low": column(np.asarray(low, dtype=np.int32), pa.int32()),
        "high": column(None if high is None else np.asarray(high, dtype=np.int32), pa.int32()),
        "anchor": column(anchor, pa.int64()), "window": column(window, pa.int64()), "rows": column(rows, pa.int64()),
    })


def runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Runs of words [low, high) of each document (``_id``, ``_th``) whose windows
    of ``min_words`` words all occur elsewhere. Runs of one document may overlap."""
    gram = max(1, min(GRAM, min_words // 2))
    keyed = _keyed(docs)
    anchors = written(_anchors(keyed, min_words, gram), "anchors")
    # Written, so that both sides of the join are plain shuffles and Spark can
    # split a frequent anchor over tasks.
    many = written(anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "anchor-counts")
    parts = F.ceil(F.col("n") / SHARE).cast("int").alias("parts")
    marks = anchors.join(many, "anchor").groupBy("_id", "_th").agg(F.collect_set(F.struct("position", parts)).alias("marks"))
    # Equal rows become one in the tasks that read them, and one in all after the shuffle.
    distinct = keyed.groupBy("_id", "_th").agg(F.first("text").alias("text"), F.count("*").alias("rows"))
    cuts = _cuts(distinct.join(marks, ["_id", "_th"]), min_words, gram)
    found = written(_extend(cuts, min_words), "repeats")
    whole = found.where("high is not null").select("_id", "_th", "low", "high")
    kinds = found.where("high is null")
    shared = kinds.groupBy("anchor", "window").agg(F.sum("rows").alias("n")).where("n > 1")
    across = kinds.join(shared, ["anchor", "window"]).select("_id", "_th", "low", (F.col("low") + min_words).alias("high"))
    return whole.unionByName(across)


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows of ``docs`` with ``n_words``, ``n_removed`` and ``kept_text``.

    Words are runs of anything but blank, tab, line feed, vertical tab, form feed
    and carriage return. A window of ``min_words`` words goes, with all of its
    words, if its words also stand in a row at any other place of any document,
    the same one included; windows are judged on the input. ``kept_text`` has the
    words left, joined by one blank. Null and empty texts have no words; repeated
    rows repeat one another; an empty table gives no rows. Extra columns stay, but
    those named like a result.
    """
    found = runs(docs, min_words).groupBy("_id", "_th").agg(F.collect_set(F.struct("low", "high")).alias("_runs"))
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("_rest"), F.col("text").isNull().alias("_null"), text.alias("text"))
    rows = rows.withColumn("_id", F.coalesce(F.col("_rest.doc_id").cast("long"), F.lit(0))).withColumn("_th", F.xxhash64("text"))
    rows = rows.join(found, ["_id", "_th"], "left").select("_rest", "_null", "text", "_runs")

    def take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in blocks(batches, "text"):
            words = Words(column)
            mark = np.zeros(len(words) + 1, dtype=np.int64)
            found = batch.column(batch.schema.get_field_index("_runs"))
            lengths = found.value_lengths().fill_null(0).to_numpy()
            base = words.doc[np.repeat(np.arange(len(column)), lengths)]
            flat = found.flatten()
            np.add.at(mark, flat.field("low").to_numpy(zero_copy_only=False) + base, 1)
            np.add.at(mark, flat.field("high").to_numpy(zero_copy_only=False) + base, -1)
            gone = np.cumsum(mark)[:-1] > 0
            removed = np.add.reduceat(np.append(gone, False), words.doc[:-1]) * (words.count > 0) if len(column) else []
            data, kept = words.data.tobytes(), []
            for i in range(len(column)):
                a, b = words.doc[i], words.doc[i + 1]
                left = np.flatnonzero(~gone[a:b]) + a
                kept.append(b" ".join([data[s:e] for s, e in zip(words.start[left].tolist(), words.end[left].tolist())]))
            fields = {n: batch.column(batch.schema.get_field_index(n)) for n in ("_rest", "_null", "text")}
            yield pa.record_batch({
                **fields, "n_words": pa.array(words.count.astype(np.int64)), "n_removed": pa.array(np.asarray(removed, dtype=np.int64)),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            })

    rest = rows.schema["_rest"].dataType.simpleString()
    out = rows.mapInArrow(take_out, f"_rest {rest}, _null boolean, text string, n_words long, n_removed long, kept_text string")
    text = F.when(~F.col("_null"), F.col("text")).alias("text")
    return out.select(*[text if c == "text" else F.col(f"_rest.`{c}`").alias(c) for c in names], "n_words", "n_removed", "kept_text")


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeats of 35 words and more taken out of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
