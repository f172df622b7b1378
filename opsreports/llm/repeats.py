"""Removal of repeated byte strings, by interval trees over sparse suffix arrays.

A suffix array over all bytes doesn't divide among tasks. Here each document picks anchors: of the
``ANCHOR``-byte strings inside every string of the wanted length, the one with the smallest hash, the leftmost of
equals. Equal strings pick the same anchor at the same place, so all their occurrences meet
under the anchor's hash. There the suffixes that begin at the anchors are sorted with their common prefixes (an
enhanced suffix array that holds the anchors only), and so are the reversed texts before the anchors. The
interval trees of both, cut at the depths that a string needs to the right and to the left of its anchor, tell
which strings are equal.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsreports.llm.bpe import text_bytes
from opsreports.llm.common import lean, passing, settle

ANCHOR = 32
_RANDOM = np.random.Generator(np.random.PCG64(8)).integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``ANCHOR`` bytes from each place on (two halves of half the length, and so on)."""
    h = _RANDOM[data]
    for step, odd in zip((1, 2, 4, 8, 16), _ODD, strict=True):
        h = h[:-step] * odd + h[step:]
    h ^= h >> np.uint64(29)
    return h * _ODD[0] ^ (h >> np.uint64(32))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def anchors(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of texts that lie end to end: (text, hash, first string's start, anchor's distance from it, strings, digest).

    The strings of an anchor follow each other; the digest is one of the bytes from the first one's start to the last one's end.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(data) < length:
        return none
    h = gram_hashes(data)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    best = (sliding_least(key, length - ANCHOR + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.arange(len(best))
    text = np.searchsorted(at, starts, side="right") - 1
    inside = starts + length <= at[text + 1]
    starts, best, text = starts[inside], best[inside], text[inside]
    if not len(starts):
        return none
    first = np.flatnonzero(np.concatenate(([True], (best[1:] != best[:-1]) | (text[1:] != text[:-1]))))
    count = np.diff(np.append(first, len(starts)))
    s0, p, doc = starts[first], best[first], text[first]
    last = s0 + count - 1 + length - ANCHOR
    digest = h[last] + ((p - s0) << 8 | count).astype(np.uint64)
    for k in range(0, 2 * length, ANCHOR):
        digest = digest * _ODD[1] + h[np.minimum(s0 + k, last)]
        digest ^= digest >> np.uint64(31)
    return doc, h[p].view(np.int64), s0 - at[doc], p - s0, count, digest.view(np.int64)


def common(sorted_texts: list[bytes]) -> np.ndarray:
    """Length of the common prefix of each text with the one before it; 0 for the first."""
    n = len(sorted_texts)
    sizes = np.fromiter(map(len, sorted_texts), np.int64, n)
    width = max(1, int(sizes.max(initial=0)))
    grid = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in sorted_texts), np.uint8).reshape(n, width)
    differ = grid[1:] != grid[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return np.concatenate(([0], np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))))


def lcp_intervals(lcp: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Nodes (depth, low, high) of the interval tree over a suffix array, by one scan with a stack; deeper ones first."""
    stack = [(0, 0)]
    for i in range(1, len(lcp) + 1):
        depth, low = int(lcp[i]) if i < len(lcp) else -1, i - 1
        while stack and stack[-1][0] > depth:
            top, low = stack.pop()
            yield top, low, i - 1
        if not stack or stack[-1][0] < depth:
            stack.append((depth, low))


def maximal_repeats(texts: list[bytes], least: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Maximal repeats of at least ``least`` bytes in few texts: (length, all occurrences (text, start)).

    A node of the interval tree is left-maximal if its suffixes differ in the byte before them, or one
    begins its text; otherwise it's part of a longer repeat.
    """
    suffixes = sorted((t[i:], k, i) for k, t in enumerate(texts) for i in range(len(t) - least + 1))
    if not suffixes:
        return
    for depth, low, high in lcp_intervals(common([s for s, _, _ in suffixes])):
        if depth >= least and high > low:
            found = [(k, i) for _, k, i in suffixes[low : high + 1]]
            if len({texts[k][i - 1] if i else (k, i) for k, i in found}) > 1:
                yield depth, sorted(found)


def _cuts(order: np.ndarray, lcp: np.ndarray, depth: int) -> np.ndarray:
    """The node of the interval tree, cut at ``depth``, under which each suffix lies."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(lcp < depth)
    return out


def repeated(group: np.ndarray, rank: np.ndarray, off: np.ndarray, count: np.ndarray, around: list[bytes], length: int) -> np.ndarray:
    """Which strings around anchors occurred earlier: a row per anchor, a column per string from its first on.

    ``group``: the anchors' hashes; ``rank``: their order of occurrence; ``around``: the bytes from the first
    string's start to the last one's end.
    """
    n = len(around)
    right = [a[o:] for a, o in zip(around, off.tolist(), strict=True)]
    left = [a[:o][::-1] for a, o in zip(around, off.tolist(), strict=True)]
    sides = []
    for texts in (right, left):
        order = np.array(sorted(range(n), key=lambda i: (group[i], texts[i])), np.int64)
        lcp = common([texts[i] for i in order])
        lcp[1:][group[order][1:] != group[order][:-1]] = -1
        lcp[0] = -1
        sides.append((order, lcp))
    out = np.zeros((n, length - ANCHOR + 1), bool)
    for r in range(length - ANCHOR + 1):  # bytes of the string before its anchor
        own = np.flatnonzero((off >= r) & (off - r < count))
        if len(own) < 2:
            continue
        a, b = _cuts(*sides[0], length - r)[own], _cuts(*sides[1], r)[own]
        by = np.lexsort((rank[own], b, a))
        same = np.concatenate(([False], (a[by][1:] == a[by][:-1]) & (b[by][1:] == b[by][:-1])))
        late = own[by[same]]
        out[late, off[late] - r] = True
    return out


def _mark(data: np.ndarray) -> int:
    """15 bits that tell apart texts of one id."""
    return zlib.crc32(data.tobytes()) & 0x7FFF


class SharedRuns:
    """Lets through the rows of a stream sorted by its first column whose value there the row before or after them has too."""

    def __init__(self):
        self.held, self.equal_before = None, False

    def push(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not batch.num_rows:
            return
        if self.held is not None:
            batch = pa.Table.from_batches([self.held, batch]).combine_chunks().to_batches()[0]
        h = batch.column(0).to_numpy()
        equal = h[1:] == h[:-1]
        keep = np.concatenate(([self.equal_before], equal))
        keep[:-1] |= equal
        yield batch.slice(0, len(h) - 1).filter(pa.array(keep[:-1]))
        self.held, self.equal_before = batch.slice(len(h) - 1), bool(keep[-1])

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.held is not None and self.equal_before:
            yield self.held


def shared_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs = SharedRuns()
    for batch in batches:
        yield from runs.push(batch)
    yield from runs.end()


def _settle_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (hash, digest, id, at) in that order: later rows of a hash and digest, which are settled; and the first ones of hashes with
    more than one digest, which are open. A hash with one digest leaves nothing open. Repeats of a row are dropped."""
    runs, before = SharedRuns(), None

    def marked(batch: pa.RecordBatch, open_: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3), pa.array([open_] * batch.num_rows, pa.bool_())], names=["hash", "id", "at", "open"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        whole = batch if before is None else pa.Table.from_batches([before, batch]).combine_chunks().to_batches()[0]
        later, earlier = whole.slice(1), whole.slice(0, whole.num_rows - 1)
        same = np.array([pc.equal(later.column(k), earlier.column(k)).to_numpy(zero_copy_only=False) for k in range(4)]).reshape(4, -1)
        equal, repeat = same[0] & same[1], same.all(axis=0)
        if before is None:
            equal, repeat = np.concatenate(([False], equal)), np.concatenate(([False], repeat))
        before = batch.slice(batch.num_rows - 1)
        yield marked(batch.filter(pa.array(equal & ~repeat)), False)
        for found in runs.push(batch.filter(pa.array(~equal))):
            yield marked(found, True)
    for found in runs.end():
        yield marked(found, True)


def find_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, chunk: int = 20_000) -> DataFrame:
    """Rows (id, n_bytes, address, spans, kept, kept_text): what each document loses if every byte goes that lies in a string of
    ``length`` bytes which also starts earlier (smaller id, or the same document and an earlier start).

    ``address``: SHA-256 of the text's UTF-8 bytes. ``spans``: array<struct<start, end>> of the maximal removed runs.
    ``kept``: the bytes that remain, null where nothing is removed; ``kept_text``: the same as text, without characters cut in two.

    Anchors travel as digests of what is around them first: all but the first of equal ones are settled by that alone. Bytes are fetched only
    for first ones whose anchor has different surroundings, and a suffix array is built of those. An anchor with more than ``chunk`` different
    surroundings (next to a passage of many documents) has no suffix array: its strings are rows of their 128-bit digests, and all but the least place
    of each digest go. So a task holds less than ``chunk`` surroundings and a batch. Only texts that have such anchors or lose bytes are
    shuffled; a filter of fixed size tells most others.

    Null and empty texts have no bytes. Rows with a null id are left as they are. Repeated rows are one document and
    each gets its result. Texts shorter than ``length`` lose nothing. An empty table gives no rows; other columns
    are ignored.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    addressed = settle(rows.select("id", F.sha2("text", 256).alias("address"), F.octet_length("text").cast("long").alias("n_bytes")), "addressed")
    searched = addressed.where((F.col("n_bytes") >= length) & F.col("id").isNotNull())
    first = searched.groupBy("address").agg(F.min("id").alias("id"), F.max("n_bytes").alias("n_bytes"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                data, at = text_bytes(part.column(1))
                doc, h, s0, off, count, digest = anchors(data, at, length)
                marks = np.array([_mark(data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], np.int64)
                places = marks[doc] << 47 | s0 << 16 | off << 8 | count if len(doc) else doc
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(digest), part.column(0).take(pa.array(doc)), pa.array(places)], names=["hash", "digest", "id", "at"]
                )

    def surround(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, places in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data = text.encode()
                mark = _mark(np.frombuffer(data, np.uint8))
                own = [(p["hash"], p["at"]) for p in places if p["at"] >> 47 == mark]
                spans = [(at >> 16 & 0x7FFFFFFF, at & 255) for _, at in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h for h, _ in own], pa.int64()), pa.array([key] * len(own), batch.schema.field(0).type), pa.array([at for _, at in own], pa.int64()),
                     pa.array([data[s0 : s0 + count - 1 + length] for s0, count in spans], pa.binary())],
                    names=["hash", "id", "at", "around"],
                )

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in surround(batches):
            digests, kept, places = [], [], []
            for k, (at, data) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                count = at & 255
                digests += [hashlib.blake2b(data[i : i + length], digest_size=16).digest() for i in range(count)]
                kept += [k] * count
                places += [(at >> 47 << 31) + (at >> 16 & 0x7FFFFFFF) + i for i in range(count)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), batch.column(1).take(pa.array(kept, pa.int64())), pa.array(places, pa.int64())], names=["digest", "id", "place"]
            )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_type = None
        rows_: list[tuple] = []  # (hash, id, at, around)
        before: tuple | None = None

        def work(part: list[tuple]) -> pa.RecordBatch:
            at = np.array([p[2] for p in part], np.int64)
            s0, off, count = at >> 16 & 0x7FFFFFFF, at >> 8 & 255, at & 255
            late = repeated(np.array([p[0] for p in part], np.int64), np.arange(len(part)), off, count, [p[3] for p in part], length)
            edge = np.diff(np.pad(late.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            row, begin = np.nonzero(edge == 1)
            _, end = np.nonzero(edge == -1)
            ids = pa.array([part[i][1] for i in row], key_type)
            return pa.RecordBatch.from_arrays([ids, pa.array(s0[row] + begin), pa.array(s0[row] + end - 1 + length)], names=["id", "start", "end"])

        for batch in batches:
            key_type = batch.schema.field(1).type
            for p in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if p[:3] != before:  # else the same place of a repeated row
                    rows_.append(p)
                    before = p[:3]
            if len(rows_) >= chunk:
                whole = next((i for i in range(len(rows_) - 1, 0, -1) if rows_[i][0] != rows_[i - 1][0]), 0)
                if whole:
                    yield work(rows_[:whole])
                    rows_ = rows_[whole:]
        if rows_:
            yield work(rows_)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, addresses, texts, lists = (batch.column(i) for i in range(4))
            spans, kept = [], []
            for text, found in zip(texts.to_pylist(), lists.to_pylist(), strict=True):
                data, merged = text.encode(), []
                for f in sorted(found, key=lambda f: (f["start"], f["end"])):
                    if merged and f["start"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], f["end"])
                    else:
                        merged.append({"start": f["start"], "end": f["end"]})
                edges = [0, *[x for m in merged for x in (m["start"], m["end"])], len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                spans.append(merged)
            yield pa.RecordBatch.from_arrays(
                [ids, addresses, pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()),
                 pa.array([k.decode(errors="ignore") for k in kept], pa.string())],
                names=["id", "address", "spans", "kept", "kept_text"],
            )

    picked = rows.where("id IS NOT NULL").mapInArrow(lean(pick), f"hash long, digest long, id {kind}, at long")
    met = settle(
        picked.repartition("hash").sortWithinPartitions("hash", "digest", "id", "at").mapInArrow(lean(_settle_equal), f"hash long, id {kind}, at long, open boolean"), "met"
    )
    firsts = first.select("id", "address")
    texts = lambda ids: passing(rows.where("id IS NOT NULL"), ids)
    own_text = F.sha2("text", 256) == F.col("address")

    def placed(found: DataFrame, label: str) -> DataFrame:
        located = settle(found.groupBy("id").agg(F.collect_set(F.struct("at", "hash")).alias("places")).join(firsts, "id"), label)
        return texts(located).join(located, "id").where(own_text).select("id", "text", "places")

    opened = met.where("open")
    crowded = settle(opened.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > chunk).select("hash"), "crowded")
    some = not crowded.isEmpty()
    quiet = opened.join(crowded, "hash", "left_anti") if some else opened
    around = placed(quiet, "located").mapInArrow(lean(surround), f"hash long, id {kind}, at long, around binary")
    judged = around.repartition("hash").sortWithinPartitions("hash", "id", "at").mapInArrow(lean(judge), f"id {kind}, start long, end long")
    if some:
        each = settle(placed(opened.join(crowded, "hash", "left_semi"), "crowd").mapInArrow(lean(strings), f"digest binary, id {kind}, place long"), "strings")
        own = F.struct("id", "place")
        least = settle(each.groupBy("digest").agg(F.min(own).alias("least"), F.max(own).alias("most")).where("least < most").select("digest", "least"), "least")
        start = F.col("place").bitwiseAND(F.lit(0x7FFFFFFF))
        late = each.join(least, "digest").where(own > F.col("least")).select("id", start.alias("start"), (start + length).alias("end"))
        judged = judged.union(late)
    begin = F.shiftright("at", 16).bitwiseAND(F.lit(0x7FFFFFFF))
    equal = met.where("NOT open").select("id", begin.alias("start"), (begin + F.col("at").bitwiseAND(F.lit(255)) - 1 + length).alias("end"))
    span = "struct<start:bigint,end:bigint>"
    gathered = judged.union(equal).groupBy("id").agg(F.collect_set(F.struct("start", "end")).alias("found"))
    gathered = settle(gathered.join(firsts, "id"), "found")
    losing = texts(gathered).join(gathered, "id").where(own_text).select("id", "address", "text", "found").dropDuplicates(["id", "address"])
    stripped = losing.mapInArrow(
        lean(strip), f"id {kind}, address string, spans array<{span}>, kept binary, kept_text string"
    )
    copied = F.col("id") != F.col("first_id")
    return addressed.join(first.select("address", F.col("id").alias("first_id")), "address", "left").join(stripped, ["id", "address"], "left").select(
        F.col("id").alias(id_col), "n_bytes", "address",
        F.when(copied, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))))
        .otherwise(F.coalesce("spans", F.array().cast(f"array<{span}>"))).alias("spans"),
        F.when(copied, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        F.when(copied, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )
