"""Near-duplicate passages by compact windows.

A text is a sequence of five-word shingles. For a hash function, all runs of
shingles that contain place c and have their least hash there form a compact
window (l, c, r): runs from l..c to c..r. The windows with room for a passage
are found from sliding minima and their bounds from a Cartesian tree (a stack
over the minima). Windows of different documents with the same least shingle
are joined on it; where the two intervals, laid over each other at c, leave
room for a passage, the words around c are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import _BASE, U64, find_words, give_back, hash_words, mix, shingle, text_blocks, trimmed

WORDS, PASSAGE, HASHES = 5, 50, 3
RUN = PASSAGE - WORDS + 1  # shingles of the shortest passage
BEFORE, AFTER = RUN - 1, RUN - 1 + WORDS  # words around c that a passage of the least length can hold
AROUND = BEFORE + AFTER
BLOCK = 14  # words of an exact part, see part_keys
FLUSH = 80_000
#: tag: a hash of the row's text, as rows with the same id may hold different ones.
RECORD = np.dtype([("key", "<u8"), ("doc", "<i8"), ("tag", "<i4"), ("at", "<i4"), ("more", "<i4"), ("left", "u1"), ("right", "u1"), ("words", "u1", (AROUND,))])  # words: a byte of each word's hash, 0 outside the window
LINK = np.dtype([("doc", "<i8"), ("tag", "<i4"), ("start", "<i4"), ("end", "<i4"), ("kept", "<i8"), ("kept_start", "<i4")])


def sliding(values: np.ndarray, n: int, pick) -> np.ndarray:
    """pick over each n neighbours, by doubling."""
    out, width = values, 1
    while width * 2 <= n:
        out = pick(out[:-width], out[width:])
        width *= 2
    return pick(out[: len(out) - (n - width)], out[n - width :]) if width < n else out


def bounds(places: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each minimum, the place after the nearest smaller one before it and that before the nearest smaller one behind it.

    The stack holds the right spine of the Cartesian tree; `starts` marks the
    first minimum of a text, at which the tree begins anew.
    """
    n = len(places)
    left, right = [-1] * n, [1 << 40] * n
    stack: list[int] = []
    at, value = places.tolist(), values.tolist()
    for i, new in enumerate(starts.tolist()):
        if new:
            stack.clear()
        v = value[i]
        while stack and value[stack[-1]] > v:
            right[stack.pop()] = at[i] - 1
        if stack:
            left[i] = at[stack[-1]] + 1
        stack.append(i)
    return np.array(left), np.array(right)


def windows(data: np.ndarray, offsets: np.ndarray, docs: np.ndarray, tags: np.ndarray | None = None) -> np.ndarray:
    """Records of all compact windows of a block of texts that have room for a passage."""
    starts, ends, rows = find_words(data, offsets)
    n = len(rows)
    if n < PASSAGE:
        return np.zeros(0, RECORD)
    tags = np.zeros(len(docs), np.int32) if tags is None else tags
    words = hash_words(data, starts, ends)
    counts = np.bincount(rows, minlength=len(docs))
    first = np.cumsum(counts) - counts
    runs = shingle(words, WORDS)
    whole = rows[: n - WORDS + 1] == rows[WORDS - 1 :]
    room = rows[: n - PASSAGE + 1] == rows[PASSAGE - 1 :]  # a passage may begin here
    codes = (words >> U64(56)).astype(np.uint8)
    codes[codes == 0] = 137
    place = np.arange(-BEFORE, AFTER)
    out = []
    for k in range(HASHES):
        value = mix(runs ^ mix(np.array([k + 1], U64)))
        small = (value >> U64(32)).astype(np.uint32)
        small[~whole] = 2**32 - 1
        least = np.where(room, sliding(small, RUN, np.minimum), 0)
        edge = np.zeros(RUN - 1, np.uint32)
        most = sliding(np.concatenate([edge, least, edge]), RUN, np.maximum)  # of the passages over a place
        c = np.flatnonzero((most == small) & whole)
        row = rows[c]
        left, right = bounds(c, small[c], np.concatenate([[True], row[1:] != row[:-1]]) if len(c) else np.zeros(0, bool))
        left, right = np.maximum(left, first[row]), np.minimum(right, first[row] + counts[row] - WORDS)
        record = np.zeros(len(c), RECORD)
        record["key"], record["doc"], record["tag"], record["at"] = value[c], docs[row], tags[row], c - first[row]
        record["left"], record["right"] = np.minimum(c - left, BEFORE), np.minimum(right - c, RUN - 1)
        inside = (place >= -record["left"].astype(np.int64)[:, None]) & (place < record["right"].astype(np.int64)[:, None] + WORDS)
        record["words"] = codes[np.clip(c[:, None] + place, 0, n - 1)] * inside
        out.append(join_neighbours(record))
    return np.concatenate(out)


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether records agree in key, bounds and words."""
    return (a["key"] == b["key"]) & (a["left"] == b["left"]) & (a["right"] == b["right"]) & (a["more"] == b["more"]) & (a["words"] == b["words"]).all(1)


def join_neighbours(records: np.ndarray) -> np.ndarray:
    """Of places with the same shingle that overlap each other, which stand in words that repeat on and on, the first and last alone; the first has `more` for how far the last is."""
    records = records[np.lexsort((records["at"], records["key"], records["tag"], records["doc"]))]
    if not len(records):
        return records
    a, b = records[:-1], records[1:]
    joined = (a["key"] == b["key"]) & (a["doc"] == b["doc"]) & (a["tag"] == b["tag"]) & (b["at"] - a["at"] <= WORDS)
    first = np.flatnonzero(np.concatenate([[True], ~joined]))
    last = np.concatenate([first[1:], [len(records)]]) - 1
    records["more"][first] = records["at"][last] - records["at"][first]
    return records[np.unique(np.concatenate([first, last]))]


def compare(a: np.ndarray, b: np.ndarray, a_words: np.ndarray, b_words: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pairs of windows: whether they share a passage, and its first and last shingle, counted from c.

    A shingle matches one of the other text at most two words off; a passage of
    RUN shingles in both windows must have a share of matches that makes the
    similarity of the two `least` or more.
    """
    need = int(np.ceil(2 * least * RUN / (1 + least) - 1e-9))
    low = np.minimum(a["left"], b["left"]).astype(np.int64)
    high = np.minimum(a["right"], b["right"]).astype(np.int64)
    shingles = AROUND - WORDS + 1
    offset = np.arange(shingles) - BEFORE
    begin = np.arange(shingles - RUN + 1)
    fits = (offset[begin] >= -low[:, None]) & (offset[begin + RUN - 1] <= high[:, None])

    def matches(rows: np.ndarray, shift: int) -> np.ndarray:
        theirs = np.zeros((len(rows), AROUND), np.uint8)
        if shift >= 0:
            theirs[:, : AROUND - shift] = b_words[rows, shift:]
        else:
            theirs[:, -shift:] = b_words[rows, :shift]
        same = (a_words[rows] == theirs) & (theirs != 0)
        out = same[:, :shingles].copy()
        for j in range(1, WORDS):
            out &= same[:, j : j + shingles]
        return out

    def passages(rows: np.ndarray, match: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros((len(rows), 1), np.int16), np.cumsum(match, 1, dtype=np.int16)], 1)
        return (total[:, RUN:] - total[:, :-RUN] >= need) & fits[rows]

    every = np.arange(len(a))
    hit = matches(every, 0)
    good = passages(every, hit)
    open_rows = np.flatnonzero(~good.any(1) & fits.any(1) & (hit.sum(1) >= need // 2))
    if len(open_rows):
        near = hit[open_rows]
        for shift in (-2, -1, 1, 2):
            near |= matches(open_rows, shift)
        hit[open_rows], good[open_rows] = near, passages(open_rows, near)
    found = good.any(1)
    start = good.argmax(1)
    end = shingles - RUN - good[:, ::-1].argmax(1) + RUN - 1
    inside = hit & (np.arange(shingles) >= start[:, None]) & (np.arange(shingles) <= end[:, None])
    return found, inside.argmax(1) - BEFORE, shingles - 1 - inside[:, ::-1].argmax(1) - BEFORE


def part_keys(records: np.ndarray, words: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with BLOCK known words at a given distance from c, and a hash of window key and words.

    Three blocks lie behind the least shingle (even numbers), three before it. A
    passage of 50 words that holds c has two of them at least, so one changed
    word leaves it one; common lines of less than BLOCK + WORDS words bring no
    windows together.
    """
    begin = BEFORE + (WORDS + (part // 2) * BLOCK if part % 2 == 0 else -(part // 2 + 1) * BLOCK)
    block = words[:, begin : begin + BLOCK]
    rows = np.flatnonzero((block != 0).all(1))
    packed = np.zeros(len(rows), U64)
    for j in range(BLOCK):
        packed = packed * U64(_BASE) + block[rows, j]
    return rows, mix(records["key"][rows] ^ mix(packed + U64(part + 1)))


def runs_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and size of runs of equal values."""
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return begin, np.diff(np.concatenate([begin, [len(keys)]]))


def of_several(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether a row's key occurs in several documents; rows are in the order of key and document."""
    if not len(keys):
        return np.zeros(0, bool)
    begin, size = runs_of(keys)
    change = np.concatenate([[False], (docs[1:] != docs[:-1]) & (keys[1:] == keys[:-1])])
    return np.repeat(np.bitwise_or.reduceat(change, begin), size)


def link_pairs(records: np.ndarray, words: np.ndarray, a: np.ndarray, b: np.ndarray, least: float, step: int = 20_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of the pairs of records that share a passage, from the larger document to the smaller, and those pairs."""
    swap = records["doc"][a] < records["doc"][b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    out, left, right = [np.zeros(0, LINK)], [a[:0]], [a[:0]]
    for at in range(0, len(a), step):
        i, j = a[at : at + step], b[at : at + step]
        found, start, end = compare(records[i], records[j], words[i], words[j], least)
        i, j = i[found], j[found]
        link = np.zeros(len(i), LINK)
        link["doc"], link["tag"], link["kept"] = records["doc"][i], records["tag"][i], records["doc"][j]
        link["start"] = records["at"][i] + start[found]
        further = np.where(end[found] >= RUN - 2, records["more"][i], 0)
        link["end"] = records["at"][i] + np.maximum(end[found], further) + WORDS
        link["kept_start"] = records["at"][j] + start[found]
        out.append(link)
        left.append(i)
        right.append(j)
    return np.concatenate(out), np.concatenate(left), np.concatenate(right)


def link_exact(records: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of records (in the order of key and document) for each run of PASSAGE same words around c that a smaller document has too, whose they are, and which records they cover whole.

    For each distance of the first word from c, records that agree in key and
    words are a group, linked with its smallest document; a record stays with
    the partner it has while that is in its group.
    """
    n = len(records)
    last = U64(pow(_BASE, PASSAGE - 1, 1 << 64))
    partner, since, covered = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64)
    total, links, whose = np.zeros(n, U64), [np.zeros(0, LINK)], [np.zeros(0, np.int64)]
    for t in range(PASSAGE):
        total = total * U64(_BASE) + words[:, BEFORE + PASSAGE - 1 - t]

    def close(i: np.ndarray, o: int) -> None:
        i = i[partner[i] >= 0]
        j = partner[i]
        link = np.zeros(len(i), LINK)
        link["doc"], link["tag"], link["kept"] = records["doc"][i], records["tag"][i], records["doc"][j]
        link["start"], link["kept_start"] = records["at"][i] - (o - 1), records["at"][j] - (o - 1)
        link["end"] = records["at"][i] - since[i] + PASSAGE
        links.append(link)
        whose.append(i)

    for o in range(RUN):
        if o:
            total = (total - words[:, BEFORE + PASSAGE - o] * last) * U64(_BASE) + words[:, BEFORE - o]
        fits = (records["left"] >= o) & (records["right"] >= RUN - 1 - o)
        hashes = mix(records["key"] ^ mix(total + U64(o + 1)))
        rows = np.flatnonzero(fits)
        rows = rows[np.argsort(hashes[rows], kind="stable")]
        begin, size = runs_of(hashes[rows])
        found = np.full(n, -1)
        first = np.repeat(rows[begin], size)
        found[rows] = np.where(records["doc"][first] != records["doc"][rows], first, -1)
        held = np.maximum(partner, 0)
        stays = (partner >= 0) & (found >= 0) & fits[held] & (hashes[held] == hashes)
        found[stays] = partner[stays]
        covered += found >= 0
        change = np.flatnonzero(found != partner)
        close(change, o)
        partner[change], since[change] = found[change], o
    close(np.arange(n), RUN)
    places = records["left"].astype(np.int64) + records["right"] - RUN + 2
    return np.concatenate(links), np.concatenate(whose), (covered >= places) & (records["more"] == 0)


def of_shared_keys(records: np.ndarray) -> np.ndarray:
    """The records whose key occurs in several documents, in the order of key, document and place."""
    order = np.lexsort((records["at"], records["doc"], records["key"]))
    return records[order[of_several(records["key"][order], records["doc"][order])]]


def join_windows(records: np.ndarray, least: float) -> np.ndarray:
    """Links between windows with the same key (see of_shared_keys) that share a passage.

    Passages of the same words are found whole by link_exact. For near ones,
    in each set with one same part the first window (by document and place) that
    isn't covered from end to end is compared with all; then the first that has
    no such link yet is compared with all, until all have one or have been
    first. Like windows of one document go through this once
    and share their links. A large set is the memory of a task, so no more than
    two copies of the records are held at a time.
    """
    if not len(records):
        return np.zeros(0, LINK)
    content = np.zeros(len(records), U64)
    for j in range(AROUND):
        content = content * U64(_BASE) + records["words"][:, j]
    order = np.lexsort((records["at"], content, records["more"], records["right"], records["left"], records["doc"], records["key"]))
    del content
    records = records[order]
    del order
    twin = np.zeros(len(records), bool)
    for at in range(1, len(records), 100_000):
        before, own = records[at - 1 : at + 99_999], records[at : at + 100_000]
        before = before[: len(own)]
        twin[at : at + 100_000] = (before["doc"] == own["doc"]) & alike(before, own)
    all_at, all_tags, group_of = records["at"].copy(), records["tag"].copy(), np.cumsum(~twin) - 1  # twins follow their chief
    records = records[~twin]
    n_twins = np.bincount(group_of)
    chiefs = np.flatnonzero(~twin)
    del group_of, twin

    words = records["words"]
    exact, whose, linked = link_exact(records, words)
    links, dups = [exact], [whose]
    for part in range(6):
        rows, keys = part_keys(records, words, part)
        order = np.argsort(keys, kind="stable")
        rows, keys = rows[order], keys[order]
        several = of_several(keys, records["doc"][rows])
        rows, keys = rows[several], keys[several]
        waiting = ~linked[rows]
        while waiting.any():
            begin, size = runs_of(keys)
            group = np.repeat(np.arange(len(begin)), size)
            leader = np.minimum.reduceat(np.where(waiting, np.arange(len(rows)), len(rows)), begin)
            here = np.flatnonzero((leader < len(rows))[group])
            lead = leader[group[here]]
            other = records["doc"][rows[here]] != records["doc"][rows[lead]]
            found, i, _ = link_pairs(records, words, rows[here[other]], rows[lead[other]], least)
            links.append(found)
            dups.append(i)
            linked[i] = True
            waiting[leader[leader < len(rows)]] = False
            waiting &= ~linked[rows]
            keep = np.repeat(np.bitwise_or.reduceat(waiting, begin), size)
            rows, keys, waiting = rows[keep], keys[keep], waiting[keep]
    found, i = np.concatenate(links), np.concatenate(dups)
    times = n_twins[i]
    out = np.repeat(found, times)
    which = np.repeat(chiefs[i], times) + np.arange(len(out)) - np.repeat(np.cumsum(times) - times, times)
    shift = all_at[which] - np.repeat(records["at"][i], times)
    out["start"] += shift
    out["end"] += shift
    out["tag"] = all_tags[which]
    return out


def merge_same(records: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Windows that agree in everything but the document: one stands for all, the others are linked with it at once."""
    records = records[np.lexsort((records["at"], records["doc"], records["key"]))]
    if not len(records):
        return records, np.zeros(0, LINK)
    same = np.concatenate([[False], alike(records[:-1], records[1:])])
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(records))))
    a = np.flatnonzero(same & (records["doc"] != records["doc"][first]))
    links, dropped, _ = link_pairs(records, records["words"], a, first[a], least)
    keep = np.ones(len(records), bool)
    keep[dropped] = False
    return records[keep], links


NAMES = ["doc_id", "tag", "start_word", "end_word", "kept_doc_id", "kept_start", "n_windows"]


def merge_links(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a document's text that overlap or touch as one, with the smallest of their partners, and how many they were."""
    if not len(links):
        return links, np.zeros(0, np.int64)
    links = links[np.lexsort((links["start"], links["tag"], links["doc"]))]
    doc = np.cumsum(np.concatenate([[0], (links["doc"][1:] != links["doc"][:-1]) | (links["tag"][1:] != links["tag"][:-1])]))
    base = doc.astype(np.int64) << 32  # ends of a smaller document lie below all starts of a larger one
    reach = np.maximum.accumulate(base + links["end"])
    first = np.concatenate([[0], np.flatnonzero(base[1:] + links["start"][1:] > reach[:-1]) + 1])
    size = np.diff(np.concatenate([first, [len(links)]]))
    island = np.repeat(np.arange(len(first)), size)
    best = np.lexsort((links["kept_start"], links["kept"], island))[first]
    out = links[first].copy()
    out["end"] = np.maximum.reduceat(links["end"], first)
    out["kept"], out["kept_start"] = links["kept"][best], links["kept_start"][best]
    return out, size


def repeated_passages(docs: DataFrame, least: float = 0.8, doc_id: str = "doc_id", text: str = "text", with_tag: bool = False) -> DataFrame:
    """doc_id, start_word, end_word, kept_doc_id, kept_start, n_windows: the words of a document in passages of 50 words or more that one of a smaller id has too.

    Words count from 0, the end is behind the last; passages that overlap or
    touch are one row. kept_doc_id is the smallest document with a part of it, which begins
    at word kept_start there; n_windows tells how many linked stretches it was merged from. doc_id must be an integer; rows without one are
    left out (they have no smaller id), rows with the same id count as one
    document of several texts, each with its own passages (with_tag: tag tells
    which, the hash() of the text), and passages that repeat within a document aren't reported. Null,
    empty and shorter texts give no row, an empty table none; whole texts are
    read, in blocks. Words are compared by a byte of their hash, so a passage may
    reach one word too far at 1 in 255 of its ends.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.hash(text).alias("tag")).filter("doc_id IS NOT NULL")
    n_buckets = 1 << min(24, max(5, (own.count() // 500).bit_length()))
    bits = n_buckets.bit_length() - 1

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            records, links = merge_same(np.concatenate(held), least)
            links, _ = merge_links(links)
            held.clear()
            cut = np.searchsorted(records["key"] >> U64(64 - bits), np.arange(1, n_buckets, dtype=U64))
            rows = [(b, 0, part.tobytes()) for b, part in enumerate(np.split(records, cut)) if len(part)]
            step = -(-len(links) // n_buckets) or 1
            rows += [(b, 1, links[b * step : (b + 1) * step].tobytes()) for b in range(-(-len(links) // step))]
            bucket, kind, data = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(data, pa.binary())], ["bucket", "kind", "data"])

        for batch in batches:
            ids, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            for a, b, data, offsets in text_blocks(batch.column(1), 1 << 20):
                held.append(windows(data, offsets, ids[a:b], tags[a:b]))
                if sum(map(len, held)) >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    def parts(table: pa.Table, kind: int, dtype: np.dtype) -> np.ndarray:
        """All of one kind, as they lie in the column's buffer."""
        data = table.filter(pa.compute.equal(table["kind"], kind))["data"].cast(pa.large_binary()).combine_chunks()
        data = data.combine_chunks() if isinstance(data, pa.ChunkedArray) else data
        if not len(data):
            return np.zeros(0, dtype)
        offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
        return np.frombuffer(data.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(dtype)

    def meet(table: pa.Table) -> pa.Table:
        found = join_windows(of_shared_keys(parts(table, 0, RECORD)), least)
        links, n = merge_links(np.concatenate([parts(table, 1, LINK), found]))
        del table, found
        give_back()
        return pa.table([pa.array(np.ascontiguousarray(links[c])) for c in ("doc", "tag", "start", "end", "kept", "kept_start")] + [pa.array(n, pa.int64())], NAMES)

    schema = "doc_id long, tag int, start_word int, end_word int, kept_doc_id long, kept_start int, n_windows long"
    links = own.mapInArrow(trimmed(emit), "bucket int, kind int, data binary").groupBy("bucket").applyInArrow(meet, schema)
    by = W.partitionBy("doc_id", "tag").orderBy("start_word", "end_word")
    new = (F.col("start_word") > F.max("end_word").over(by.rowsBetween(W.unboundedPreceding, -1))).cast("int")
    islands = links.withColumn("new", F.coalesce(new, F.lit(0))).withColumn("island", F.sum("new").over(by))
    kept = F.min(F.struct("kept_doc_id", "kept_start"))
    merged = islands.groupBy("doc_id", "tag", "island").agg(F.min("start_word").alias("start_word"), F.max("end_word").alias("end_word"), kept.alias("kept"), F.sum("n_windows").alias("n_windows"))
    return merged.select("doc_id", *(["tag"] if with_tag else []), "start_word", "end_word", "kept.kept_doc_id", "kept.kept_start", "n_windows")


def cut_repeats(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """docs (doc_id, text and other columns) without the passages that a document of a smaller id has; n_chars, if there, follows.

    The spaces around a removed passage stay as they are. A document of which
    no word is left goes; one that had no words stays, and so does a null text.
    Rows with the same id and text are cut alike; of rows with the same id and
    different texts each loses its own passages alone. Other columns may have any
    name.
    """
    names = docs.columns
    spans = repeated_passages(docs, least, with_tag=True).groupBy("doc_id", "tag").agg(F.sort_array(F.collect_set(F.struct("start_word", "end_word"))).alias("spans"))
    spans = spans.select(F.struct("doc_id", "tag").alias("of"), "spans")
    rows = docs.select(F.struct(*names).alias("doc"), F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.hash("text").alias("tag")).alias("own"))
    joined = rows.join(spans, F.col("own") == F.col("of"), "left").select("doc.*", F.col("spans").alias("_".join([*names, "spans"])))
    text_at, chars_at = names.index("text"), names.index("n_chars") if "n_chars" in names else -1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, keep = batch.column(text_at).to_pylist(), [], np.ones(batch.num_rows, bool)
            for i, spans in enumerate(batch.column(len(names)).to_pylist()):
                if spans and texts[i] is not None:
                    raw = np.frombuffer(texts[i].encode(), np.uint8)
                    starts, ends, _ = find_words(raw, np.array([0, len(raw)]))
                    parts, at, word = [], 0, 0
                    for s in spans:
                        if s["start_word"] > word:
                            parts.append(raw[at : starts[s["start_word"]]])
                        if s["end_word"] > word:
                            word = s["end_word"]
                            at = int(starts[word]) if word < len(starts) else int(ends[-1])
                    texts[i] = b"".join([p.tobytes() for p in [*parts, raw[at:]]]).decode()
                    keep[i] = word < len(starts) or bool(parts)
                sizes.append(len(texts[i]) if texts[i] is not None else None)
            columns = list(batch.columns[: len(names)])
            columns[text_at] = pa.array(texts, columns[text_at].type)
            if chars_at >= 0:
                changed = pa.array([bool(s) for s in batch.column(len(names)).to_pylist()])
                columns[chars_at] = pa.compute.if_else(changed, pa.array(sizes, columns[chars_at].type), columns[chars_at])
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    return joined.mapInArrow(trimmed(cut), docs.schema)
