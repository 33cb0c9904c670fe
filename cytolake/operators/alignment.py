"""Reads: filters, best alignments, re-scoring against the reference, QC tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..functions.sequence import base_quality, cigar_sum, limit_of, reverse_complement
from ..sources.sequences import CHUNK, OVERLAP, as_chunks, sequence_lengths
from .intervals import numbered_islands
from .sites import merge_palindromes, pileup


def filter_reads(reads: DataFrame, mapq: int = 0, soft: str = "0.2", errors: str = "0.05", mismatches: str | None = None, gaps: str | None = None, multi: bool = False) -> DataFrame:
    """Mapped reads (flags 4, 512 and 1024 unset) of better quality than `mapq`, within the limits and, unless `multi`, with one place per mate."""
    kept = reads.filter(F.col("flag").bitwiseAND(0x604) == 0)
    if not multi:
        # the count covers all mapped places of a mate, before other limits apply
        kept = kept.withColumn("n_places", F.count("*").over(W.partitionBy("qname", "mate"))).filter("n_places = 1").drop("n_places")
    errors_of = F.col("mism") + F.col("ins") + F.col("del")
    kept = kept.filter((F.col("mapq") > mapq) & (F.col("soft") <= limit_of(soft, F.col("len"))) & (errors_of <= limit_of(errors, F.col("len"))))
    if mismatches is not None:
        kept = kept.filter(F.col("mism") <= limit_of(mismatches, F.col("len")))
    if gaps is not None:
        kept = kept.filter(F.col("ins") + F.col("del") <= limit_of(gaps, F.col("len")))
    return kept


def best_alignments(hits: DataFrame, by: tuple[str, ...] = ("qname", "mate"), cost: str = "cost", unique: bool = False) -> DataFrame:
    """Alignments of least cost per read, ties all; with `unique`, reads of one best alone."""
    w = W.partitionBy(*by)
    best = hits.withColumn("best_rank", F.rank().over(w.orderBy(cost))).filter("best_rank = 1").drop("best_rank")
    return best.withColumn("n_best", F.count("*").over(w)).filter("n_best = 1").drop("n_best") if unique else best


_PIECES = re.compile(r"(\d+)([MIDNSHP=X])")


def _bytes(texts: pa.Array, upper: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(Upper-case) bytes of all texts one behind the other, and where each begins."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    return np.where((raw >= 97) & (raw <= 122), raw - 32, raw).astype(np.uint8) if upper else raw, at - at[0]


def _md(places: list[tuple[int, str]], total: int) -> str:
    """An MD tag from (aligned bases before, what is written) of changed and deleted bases."""
    out, last = [], 0
    for at, text in places:
        out += [str(at - last), text]
        last = at + (text[0] != "^")
    return "".join([*out, str(total - last)])


class _Laid:
    """Aligned bases of a batch of reads over their reference spans, which begin at `lead` of the bases given."""

    def __init__(self, modes: pa.Array, cigars: pa.Array, seqs: pa.Array, spans: pa.Array, lead: np.ndarray | int = 0) -> None:
        self.n = n = len(cigars)
        kinds = pc.fill_null(cigars, "").dictionary_encode()  # each cigar is taken apart once
        kinds = kinds.combine_chunks() if isinstance(kinds, pa.ChunkedArray) else kinds
        parts = [[(int(k), op) for k, op in _PIECES.findall(c)] for c in kinds.dictionary.to_pylist()]
        which, counts = kinds.indices.to_numpy().astype(np.int64), np.array([len(x) for x in parts] or [0])
        starts, own = np.cumsum(counts) - counts, counts[which]
        self.row = row = np.repeat(np.arange(n), own)
        op = np.arange(len(row)) - np.repeat(np.cumsum(own) - own - starts[which], own)
        flat = [x for p in parts for x in p]
        self.size = size = np.array([k for k, _ in flat], np.int64)[op]
        self.code = code = np.array([c for _, c in flat] or [""], "U1")[op]
        first = np.cumsum(own) - own

        def offsets(ops: str) -> np.ndarray:
            used = np.where(np.isin(code, list(ops)), size, 0)
            before = np.cumsum(used) - used
            return before - before[first[row]] if len(row) else before

        in_read, self.in_ref, self.in_both = offsets("M=XIS"), offsets("M=XDN"), offsets("M=X")
        aligned = np.flatnonzero(np.isin(code, list("M=X")))
        width = size[aligned]
        step = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        self.q, self.r, self.k, self.of = (np.repeat(x[aligned], width) + y for x, y in ((in_read, step), (self.in_ref, step), (self.in_both, step), (row, 0)))
        (seq, self.seq_at), (self.ref, self.ref_at) = _bytes(seqs), _bytes(spans)
        self.at = self.ref_at[self.of] + (lead[self.of] if isinstance(lead, np.ndarray) else lead) + self.r

        def base(data: np.ndarray, begin: np.ndarray, place: np.ndarray) -> np.ndarray:
            return np.where(place < begin[self.of + 1], data[np.minimum(place, len(data) - 1)] if len(data) else 0, 0)

        self.mine, self.theirs = base(seq, self.seq_at, self.seq_at[self.of] + self.q), base(self.ref, self.ref_at, self.at)
        self.c_mode = pc.fill_null(pc.equal(modes, "C"), False).to_numpy(zero_copy_only=False)
        is_c = self.c_mode[self.of]
        target = self.theirs == np.where(is_c, ord("C"), ord("G"))
        self.kept, self.turned = target & (self.mine == self.theirs), target & (self.mine == np.where(is_c, ord("T"), ord("A")))

    def per(self, rows: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(rows, weights, self.n).astype(np.int64)


def _score(modes: pa.Array, cigars: pa.Array, seqs: pa.Array, spans: pa.Array) -> list[pa.Array]:
    """errors, clip, skip, md, ym and yu of a batch of reads laid over their reference spans."""
    x = _Laid(modes, cigars, seqs, spans)
    wrong = (x.theirs != x.mine) & ~x.turned
    gaps = np.isin(x.code, ["I", "D"])
    errors = x.per(x.of[wrong]) + x.per(x.row[gaps], x.size[gaps])
    sums = [x.per(x.row[m], x.size[m]) for m in (np.isin(x.code, ["S", "H"]), x.code == "N")]
    places: dict[int, list[tuple[int, str]]] = {}  # of the reads that have any
    for i, at, b in zip(x.of[wrong].tolist(), x.k[wrong].tolist(), x.theirs[wrong].tolist(), strict=True):
        places.setdefault(i, []).append((at, chr(b or 78)))
    for j in np.flatnonzero(x.code == "D").tolist():
        i = int(x.row[j])
        begin = int(x.ref_at[i] + x.in_ref[j])
        lost = x.ref[begin : min(begin + int(x.size[j]), int(x.ref_at[i + 1]))].tobytes().decode()
        places.setdefault(i, []).append((int(x.in_both[j]), "^" + lost))
    total = x.per(x.of)
    md = total.astype(str).astype(object)
    for i, p in places.items():
        md[i] = _md(sorted(p, key=lambda y: (y[0], y[1][0] != "^")), int(total[i]))
    lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(x.per(x.of[m]))]), pa.int32()), pa.array(x.r[m] + 1, pa.int64())) for m in (x.kept, x.turned)]
    return [pa.array(errors), *map(pa.array, sums), pa.array(md, pa.string()), *lists]


#: Bases of a block in which a chunk is looked up.
BLOCK = 128


def in_blocks(chunks: DataFrame) -> DataFrame:
    """chunks whose bases are an array of blocks, so that a cut does not count its way through the whole chunk."""
    return chunks.withColumn("bases", F.regexp_extract_all("bases", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))


def cut(at: Column, length: Column) -> Column:
    """`length` bases from `at` (from 1) on of a chunk in_blocks, up to its end."""
    first, skip = F.floor((at - 1) / BLOCK).cast("int"), F.pmod(at - 1, F.lit(BLOCK))
    held = F.slice("bases", first + 1, F.greatest(F.ceil((skip + length) / BLOCK).cast("int"), F.lit(0)))
    return F.substring(F.array_join(held, ""), skip + 1, length)


def rescore(reads: DataFrame, chunks: DataFrame, size: int = CHUNK) -> DataFrame:
    """reads (with mode, ref, pos, cigar, seq) against unconverted bases: adds errors, clip, skip, md, and ym and yu, offsets (from 1, along the reference) of methylated and converted bases.

    Mode C looks at C (read C: methylated, T: converted), mode G at G (G, A); a
    converted base is no error. Each read takes along the bases that it spans alone.
    """
    placed = reads.withColumn("chunk", F.floor((F.col("pos") - 1) / size)).join(in_blocks(chunks), ["ref", "chunk"])
    span = cut((F.col("pos") - F.col("chunk_start")).cast("int"), cigar_sum(F.col("cigar"), "MDN=X").cast("int"))
    rows = placed.select(*reads.columns, span.alias("span_bases"))
    at, names = [rows.columns.index(c) for c in ("mode", "cigar", "seq", "span_bases")], [*reads.columns, "errors", "clip", "skip", "md", "ym", "yu"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _score(*(batch.column(i) for i in at))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *scores], names)

    schema = StructType([*reads.schema.fields, *[StructField(c, LongType()) for c in ("errors", "clip", "skip")], StructField("md", StringType()), *[StructField(c, ArrayType(LongType())) for c in ("ym", "yu")]])
    return rows.mapInArrow(walk, schema)


def best_conversions(scored: DataFrame, unique: bool = False) -> DataFrame:
    """Of the alignments of a read to the converted genomes (conversion: which one) those of fewest errors and clipped bases."""
    return best_alignments(scored.withColumn("cost", F.col("errors") + F.col("clip")), unique=unique)


def calls_of(scored: DataFrame, min_quality: int = 0, encoding: int = 33) -> DataFrame:
    """A row per call: qname, mate, mode, flag, ref, pos (from 1), offset (in the read's span, from 1), meth, and baseq if the reads have `qual`; calls of less than `min_quality` go."""
    quality = "qual" in scored.columns
    # places in the read are found before calls are dealt out; a read aligned in one piece has them already
    rows = scored.withColumn("in_one", F.col("cigar").rlike("^[0-9]+[M=X]$")) if quality else scored
    columns = ["qname", "mate", "mode", "flag", "ref", (F.col("pos") + F.col("call.offset") - 1).alias("pos"), F.col("pos").alias("read_pos"), F.col("call.offset").alias("offset"), F.col("call.meth").alias("meth")]
    places = lambda c: F.when(F.col("in_one"), F.col(c)).otherwise(F.transform(c, lambda o: read_offset(F.col("cigar"), o)))
    sides = [F.arrays_zip(F.col(c).alias("offset"), F.array_repeat(F.lit(meth), F.size(c)).alias("meth"), *([places(c).alias("place")] if quality else [])) for c, meth in (("ym", 1), ("yu", 0))]
    if quality:
        columns.append(base_quality(F.col("qual"), F.col("call.place").cast("int"), encoding).alias("baseq"))
    out = rows.select(*rows.columns, F.explode(F.concat(*sides)).alias("call")).select(*columns)
    return out.filter(F.col("baseq") >= min_quality) if quality else out


def call_contexts(calls: DataFrame, chunks: DataFrame, k: int = 3, size: int = CHUNK) -> DataFrame:
    """calls with the strand of their base (C: +, G: -) and the k bases from it, read along that strand."""
    placed = calls.withColumn("chunk", F.floor((F.col("pos") - 1) / size)).join(in_blocks(chunks), ["ref", "chunk"])
    at = (F.col("pos") - F.col("chunk_start")).cast("int")
    base = F.upper(cut(at, F.lit(1)))
    ahead, back = F.upper(cut(at, F.lit(k))), F.upper(cut(F.greatest(at - k + 1, F.lit(1)), F.least(at, F.lit(k))))
    rows = placed.withColumns({"strand": F.when(base == "C", "+").when(base == "G", "-"), "context": F.when(base == "C", ahead).when(base == "G", reverse_complement(back))})
    return rows.filter("strand IS NOT NULL").select(*calls.columns, "strand", "context")


def filled_calls(reads: DataFrame, fixes: DataFrame) -> DataFrame:
    """Bases that end repair filled in: qname, mate, ref, pos (of the base), read_pos and offset (in the read's span, from 1).

    They are a read's last two bases (mode C) or first two (mode G), if no more
    than two bases are clipped on that side, where the base is the strand's (C
    forward, G reverse) and its place is in `fixes` (ref, pos, strand). Places
    follow from the cigar; a base that is clipped or inserted has none.
    """
    edge = {"left": F.regexp_extract("cigar", "^([0-9]+)[SH]", 1), "right": F.regexp_extract("cigar", "([0-9]+)[SH]$", 1)}
    clip = F.coalesce(F.when(F.col("mode") == "C", edge["right"]).otherwise(edge["left"]).try_cast("int"), F.lit(0))
    n = F.length("seq")
    ends = F.when(F.col("mode") == "C", F.array(n - 1, n)).otherwise(F.array(F.lit(1), F.lit(2)))
    back = F.col("flag").bitwiseAND(16) != 0
    rows = reads.filter(clip <= 2).select("qname", "mate", "ref", F.col("pos").alias("read_pos"), "cigar", "seq", F.when(back, "-").otherwise("+").alias("strand"), F.explode(ends).alias("place"))
    fits = F.substring("seq", F.col("place"), F.lit(1)) == F.when(F.col("strand") == "-", "G").otherwise("C")
    rows = rows.filter(fits & (F.col("place") > 0)).withColumn("offset", span_offset(F.col("cigar"), F.col("place"))).filter("offset IS NOT NULL")
    rows = rows.withColumn("pos", F.col("read_pos") + F.col("offset") - 1)
    return rows.join(fixes.select("ref", "pos", "strand").distinct(), ["ref", "pos", "strand"], "left_semi").select("qname", "mate", "ref", "pos", "read_pos", F.col("offset").cast("long").alias("offset"))


def drop_filled_ends(calls: DataFrame, filled: DataFrame) -> DataFrame:
    """calls without the filled-in bases (see filled_calls)."""
    return calls.join(filled, ["qname", "mate", "ref", "pos", "read_pos", "offset"], "left_anti").select(calls.columns)


def fill_in_log(filled: DataFrame) -> DataFrame:
    """Reads per place that was fixed."""
    return filled.groupBy("ref", "pos").agg(F.count("*").alias("n_reads"))


def motif_starts(refs: DataFrame, motif: str, size: int = CHUNK) -> DataFrame:
    """Places (ref, at, from 0) of a motif, any case and not overlapping each other, the first of those that would.

    Found in overlapping chunks: cut before every occurrence, a chunk falls into
    pieces whose lengths add up to the places.
    """
    motif = motif.upper()
    bases = F.upper("bases")
    chunks = as_chunks(refs, size, len(motif) - 1, 0).filter(bases.contains(motif))
    lengths = F.transform(F.split(bases, f"(?={motif})"), lambda x: F.length(x))
    pieces = chunks.select("ref", "chunk_start", bases.startswith(motif).alias("at_once"), F.posexplode(lengths).alias("k", "n"))
    at = F.coalesce(F.sum("n").over(W.partitionBy("ref", "chunk_start").orderBy("k").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    found = pieces.withColumn("at", at).filter((F.col("k") > 0) | F.col("at_once"))
    places = found.filter(F.col("at") < size).select("ref", (F.col("chunk_start") + F.col("at")).alias("at"))
    if not any(motif[k:] == motif[:-k] for k in range(1, len(motif))):
        return places
    runs = numbered_islands(places.select("ref", F.col("at").alias("start_pos"), F.col("at").alias("end_pos")), len(motif) - 1, ("ref",))
    run = runs.groupBy("ref", "island").agg(F.sort_array(F.collect_list("start_pos")).alias("all"))
    none = F.array().cast("array<bigint>")
    chosen = F.aggregate("all", none, lambda acc, x: F.when((F.size(acc) == 0) | (x - F.try_element_at(acc, F.lit(-1)) >= len(motif)), F.concat(acc, F.array(x))).otherwise(acc))
    return run.select("ref", F.explode(chosen).alias("at"))


def fix_places(refs: DataFrame, fixes: list[tuple[str, str, int]]) -> DataFrame:
    """Places (ref, pos from 1, strand) where end repair fills in, by rules (motif, strand, offset from the motif's start)."""
    parts = [motif_starts(refs, motif).select("ref", (F.col("at") + offset).alias("pos"), F.lit(strand).alias("strand")) for motif, strand, offset in fixes]
    return reduce(DataFrame.unionByName, parts)


def motif_sites(refs: DataFrame, motif: str, cut: int, size: int = CHUNK) -> DataFrame:
    """Cuts of an enzyme: ref, start_pos (of the cut, from 0), end_pos two further."""
    return motif_starts(refs, motif, size).select("ref", (F.col("at") + cut).alias("start_pos"), (F.col("at") + cut + 2).alias("end_pos"))


def digest(refs: DataFrame, motif: str, cut: int, size: int = CHUNK) -> DataFrame:
    """Fragments between cuts: ref, start_pos, end_pos, seq; a sequence without cuts is one fragment.

    A fragment meets the chunks that it lies in, each of which gives its part.
    """
    cuts = motif_sites(refs, motif, cut, size).select("ref", F.col("start_pos").alias("at"))
    bounds = cuts.union(sequence_lengths(refs).select("ref", F.lit(0).cast("long"))).union(sequence_lengths(refs)).distinct()
    spans = bounds.withColumn("end_pos", F.lead("at").over(W.partitionBy("ref").orderBy("at"))).filter("end_pos > at")
    placed = spans.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("at") / size), F.floor((F.col("end_pos") - 1) / size))))
    parts = placed.join(as_chunks(refs, size, 0, 0), ["ref", "chunk"])
    low, high = F.greatest("at", "chunk_start"), F.least(F.col("end_pos"), F.col("chunk_start") + size)
    piece = F.substring("bases", (low - F.col("chunk_start") + 1).cast("int"), (high - low).cast("int"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", piece.alias("piece")))), lambda x: x["piece"]), "")
    return parts.groupBy("ref", F.col("at").alias("start_pos"), "end_pos").agg(whole.alias("seq"))


def call_methylation(reads: DataFrame, refs: DataFrame, fixes: list[tuple[str, str, int]] | None = None, min_quality: int = 0, k: int = 3, size: int = CHUNK) -> DataFrame:
    """Aligned reads (qname, mate, mode, flag, ref, pos, cigar, seq, qual) to counts per base: ref, pos, strand, context, m, u, mqual, uqual, score, qscore.

    Reads are scored against the unconverted reference, their calls lose filled-in
    bases (if there are rules) and low qualities, get context and strand, and are counted.
    """
    chunks = as_chunks(refs, size)
    if fixes:
        chunks = chunks.join(chunk_fixes(fix_places(refs, fixes), size), ["ref", "chunk"], "left")
    return pileup(context_calls(reads, chunks, min_quality, k, size), min_quality, ("ref", "pos", "strand", "context"))


def chunk_fixes(places: DataFrame, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Fixed places (ref, pos, strand) by the chunks that reach them: ref, chunk and an array of pos * 2, and 1 more on the reverse strand."""
    at = F.col("pos") - 1
    rows = places.withColumn("chunk", F.explode(F.sequence(F.floor(F.greatest(at - overlap, F.lit(0)) / size), F.floor(at / size))))
    return rows.groupBy("ref", "chunk").agg(F.collect_set(F.col("pos") * 2 + (F.col("strand") == "-").cast("int")).alias("fixed"))


def context_calls(reads: DataFrame, chunks: DataFrame, min_quality: int = 0, k: int = 3, size: int = CHUNK, encoding: int = 33) -> DataFrame:
    """Calls of aligned reads with strand and context: ref, pos, strand, context, meth and baseq, in one pass over the reads.

    Where chunks have `fixed` (see chunk_fixes), filled-in bases (see
    filled_calls) are no calls. A read takes along what it spans, k - 1 bases on
    both sides, and the fixed places within, so its calls need no further join.
    """
    placed = reads.withColumn("chunk", F.floor((F.col("pos") - 1) / size)).join(in_blocks(chunks), ["ref", "chunk"])
    begin, span = (F.col("pos") - F.col("chunk_start")).cast("int"), cigar_sum(F.col("cigar"), "MDN=X").cast("int")
    lead = F.least(begin - 1, F.lit(k - 1))
    own = ["ref", "pos", "mode", "flag", "cigar", "seq", "qual"]
    columns = [*own, lead.alias("lead"), cut(begin - lead, lead + span + k - 1).alias("span_bases")]
    if "fixed" in chunks.columns:
        columns.append(F.filter("fixed", lambda x: (x >= F.col("pos") * 2) & (x < (F.col("pos") + span) * 2)).alias("fixed"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns, strict=True))
            before = column["lead"].to_numpy(zero_copy_only=False).astype(np.int64)
            x = _Laid(column["mode"], column["cigar"], column["seq"], column["span_bases"], before)
            start, flag = (column[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pos", "flag"))
            qual, qual_at = _bytes(column["qual"], upper=False)
            place = qual_at[x.of] + x.q
            known = place < qual_at[x.of + 1]
            quality = np.where(known, qual[np.minimum(place, len(qual) - 1)].astype(np.int64) - encoding if len(qual) else 0, -1)
            call = (x.kept | x.turned) & known & (quality >= min_quality)
            if "fixed" in column:
                call &= ~_filled(x, column, start, flag)
            at, of, c = x.at[call], x.of[call], x.c_mode[x.of[call]]
            letters = np.zeros((len(at), k), np.uint8)
            for i in range(k):  # along the strand: on, or back and complemented
                near = np.where(c, at + i, at - i)
                inside = (near >= x.ref_at[of]) & (near < x.ref_at[of + 1])
                base = np.where(inside, x.ref[np.clip(near, 0, len(x.ref) - 1)], 0) if len(x.ref) else np.zeros(len(at), np.uint8)
                letters[:, i] = np.where(c, base, _COMPLEMENT[base])
            length = (letters > 0).sum(1)
            text = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.py_buffer(letters[letters > 0].tobytes())])
            strand = pa.DictionaryArray.from_arrays(pa.array(np.where(c, 0, 1), pa.int32()), pa.array(["+", "-"])).cast(pa.string())
            out = [column["ref"].take(pa.array(of)), pa.array(start[of] + x.r[call]), strand, text, pa.array(x.kept[call].astype(np.int32)), pa.array(quality[call].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, ["ref", "pos", "strand", "context", "meth", "baseq"])

    kind = reads.schema["ref"].dataType.simpleString()
    return placed.select(*columns).mapInArrow(walk, f"ref {kind}, pos long, strand string, context string, meth int, baseq int")


_COMPLEMENT = np.arange(256, dtype=np.uint8)
_COMPLEMENT[list(b"ACGT")] = list(b"TGCA")


def _filled(x: _Laid, column: dict[str, pa.Array], start: np.ndarray, flag: np.ndarray) -> np.ndarray:
    """Which aligned bases were filled in, by the rules of filled_calls."""
    clips = [np.zeros(x.n, np.int64), np.zeros(x.n, np.int64)]
    clipped = np.isin(x.code, ["S", "H"])
    edges = np.r_[True, x.row[1:] != x.row[:-1]] if len(x.row) else np.zeros(0, bool), np.r_[x.row[1:] != x.row[:-1], True] if len(x.row) else np.zeros(0, bool)
    for clip, edge in zip(clips, edges, strict=True):
        clip[x.row[edge & clipped]] = x.size[edge & clipped]
    near = np.where(x.c_mode, clips[1], clips[0]) <= 2
    length, back = np.diff(x.seq_at), flag & 16 != 0
    end = np.where(x.c_mode[x.of], x.q >= length[x.of] - 2, x.q < 2) & near[x.of] & (x.mine == np.where(back[x.of], ord("G"), ord("C")))
    listed = pc.fill_null(column["fixed"], [])
    fixed = listed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(x.n), pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64))
    key = lambda of, place, reverse: of << 40 | (place - start[of]) << 1 | reverse
    hit = np.zeros(len(x.q), bool)
    hit[end] = np.isin(key(x.of[end], start[x.of[end]] + x.r[end], back[x.of[end]].astype(np.int64)), key(owner, fixed >> 1, fixed & 1))
    return hit


def palindrome_sites(counts: DataFrame, context: str = "CG") -> DataFrame:
    """Counts of a palindromic context as sites (0-based, half open), both strands in one row."""
    n = len(context)
    own = counts.filter(F.col("context").startswith(context))
    start = F.when(F.col("strand") == "+", F.col("pos") - 1).otherwise(F.col("pos") - n)
    sites = own.select("ref", start.alias("start_pos"), (start + n).alias("end_pos"), (F.col("m") + F.col("u")).alias("cov"), "m", "strand")
    return merge_palindromes(sites)


def _pieces(cigar: Column) -> Column:
    """The (n, op) of a cigar."""
    return F.arrays_zip(F.regexp_extract_all(cigar, F.lit("([0-9]+)[MIDNSHP=X]"), 1).alias("n"), F.regexp_extract_all(cigar, F.lit("[0-9]+([MIDNSHP=X])"), 1).alias("op"))


def span_offset(cigar: Column, place: Column) -> Column:
    """Offset along the reference span (from 1) of the read's base at `place` (from 1), the other way round than read_offset; null for clipped and inserted bases."""
    none = F.lit(None).cast("long")
    first = F.struct(F.lit(0).cast("long").alias("read"), F.lit(0).cast("long").alias("span"), none.alias("found"))

    def step(acc: Column, x: Column) -> Column:
        n, op = x["n"].cast("long"), x["op"]
        here = op.isin("M", "=", "X") & (acc["read"] < place) & (place <= acc["read"] + n)
        found = F.coalesce(acc["found"], F.when(here, acc["span"] + place - acc["read"]).otherwise(none))
        read = acc["read"] + F.when(op.isin("M", "=", "X", "I", "S"), n).otherwise(0)
        return F.struct(read.alias("read"), (acc["span"] + F.when(op.isin("M", "=", "X", "D", "N"), n).otherwise(0)).alias("span"), found.alias("found"))

    return F.aggregate(_pieces(cigar), first, step, lambda acc: acc["found"])


def read_offset(cigar: Column, offset: Column) -> Column:
    """Place in the read (from 1) of an aligned base that lies `offset` (from 1) along the reference: insertions and clips before it add, deletions and skips take away."""
    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("shift"))

    def step(acc: Column, x: Column) -> Column:
        n, op, before = x["n"].cast("long"), x["op"], acc["at"] < offset
        shift = F.when(before & op.isin("I", "S"), n).when((acc["at"] + n < offset) & op.isin("D", "N"), -n).otherwise(0)
        return F.struct((acc["at"] + F.when(op.isin("M", "=", "X", "D", "N"), n).otherwise(0)).alias("at"), (acc["shift"] + shift).alias("shift"))

    return offset + F.aggregate(_pieces(cigar), first, step, lambda acc: acc["shift"])


def inconsistent(reads: DataFrame) -> DataFrame:
    """Reads whose NM tag is not the sum of mismatches, inserted and deleted bases; there should be none."""
    return reads.filter(F.col("nm") != F.col("mism") + F.col("ins") + F.col("del"))


def in_read_order(alignments: DataFrame, reads: DataFrame) -> DataFrame:
    """alignments with the number (ord) that their read has in its FASTQ file; ids match without /1 and /2."""
    plain = lambda c: F.regexp_replace(F.regexp_extract(c, r"^(\S+)", 1), "/[12]$", "")
    numbered = reads.select(plain("id").alias("read_key"), "ord", F.col("seq").alias("original"))
    return alignments.withColumn("read_key", plain("qname")).join(numbered, "read_key").drop("read_key")


def mapping_summary(reads: DataFrame, low: int = 10) -> DataFrame:
    """A mapping report (section, key, n) from alignments, one aggregate per read and one over all of its sections.

    Columns: qname, mate (0 single, 1, 2), flag, ref, mapq, len, soft, hard, ins,
    del, mism, tlen. A mate's code is 0 unmapped, 1 one place, 3 several, and -1
    in `pairs` where a mate lacks; quality up to `low` is low. Histograms of
    mismatches, gaps, errors and clips are of mates with one place.
    """
    values = ("flag", "mapq", "len", "soft", "hard", "mism", "tlen")
    least = F.min(F.struct("ref", "pos", *values, (F.col("ins") + F.col("del")).alias("gaps"))).alias("v")  # of several places the first
    rev, mapped = F.col("flag").bitwiseAND(16) > 0, F.col("flag").bitwiseAND(4) == 0
    mates = reads.groupBy("qname", "mate").agg(F.count("*").alias("places"), least).select("qname", "mate", "places", *[f"v.{c}" for c in ("ref", *values, "gaps")]).withColumn("code", F.when(F.col("places") > 1, 3).when(mapped, 1).otherwise(0))
    one, found = F.col("code") == 1, F.col("code") > 0
    cell = lambda section, key, when=F.lit(True): F.when(when, F.struct(F.lit(section).alias("section"), key.cast("string").alias("key")))
    direction = F.when(rev, "reverse").otherwise("forward")
    cells = F.array(
        cell("reads", F.lit("total")), cell("reads", F.lit("multi"), F.col("code") == 3), cell("reads", F.concat(F.lit("unique "), direction), one), cell("reads", F.lit("low unique"), one & (F.col("mapq") <= low)),
        cell("reads", F.when(F.col("mate") == 0, "single").otherwise(F.concat(F.lit("read"), F.col("mate")))),
        cell("locations", F.col("places"), found), cell("lengths", F.col("len"), found), cell("unique lengths", F.col("len"), one), cell("mismatches", F.col("mism"), one), cell("gaps", F.col("gaps"), one),
        cell("errors", F.col("mism") + F.col("gaps"), one), cell("soft clips", F.col("soft"), one), cell("hard clips", F.col("hard"), one),
    )
    kept = F.col("mate") > 0
    code = lambda m: F.coalesce(F.max(F.when(F.col("mate") == m, F.col("code"))), F.lit(-1))
    pairs = mates.filter(kept).groupBy("qname").agg(code(1).alias("c1"), code(2).alias("c2"), F.max(F.when(F.col("mate") == 1, F.col("ref"))).alias("r1"), F.max(F.when(F.col("mate") == 2, F.col("ref"))).alias("r2"), F.max(F.when(F.col("mate") == 1, F.col("tlen"))).alias("t"))
    both = (F.col("c1") == 1) & (F.col("c2") == 1)
    insert = F.when(F.col("r1") != F.col("r2"), "other reference").when(F.col("t") == 0, "none").otherwise("some")
    pair_cells = F.array(cell("pairs", F.concat_ws("=", F.col("c1").cast("string"), F.col("c2").cast("string"))), cell("inserts", insert, both))
    codes = mates.select("qname", "mate", "code")
    placed = reads.join(codes, ["qname", "mate"]).filter("code > 0")
    by_ref = placed.select(F.lit("references").alias("section"), F.concat_ws(" ", "ref", F.when(F.col("code") == 1, "unique").otherwise("multi"), direction).alias("key"))
    rows = mates.select(F.explode(cells).alias("cell")).filter("cell IS NOT NULL").select("cell.*").unionByName(pairs.select(F.explode(pair_cells).alias("cell")).filter("cell IS NOT NULL").select("cell.*")).unionByName(by_ref)
    return rows.groupBy("section", "key").agg(F.count("*").alias("n"))


def merge_summaries(summaries: DataFrame) -> DataFrame:
    """Summaries of several files as one: counts add up, and shares of the section follow."""
    added = summaries.groupBy("section", "key").agg(F.sum("n").alias("n"))
    return added.withColumn("percent", 100 * F.col("n") / F.sum("n").over(W.partitionBy("section")))


def methylation_bias(calls: DataFrame, offset: str = "offset") -> DataFrame:
    """Levels by place in the read, following base and strand (calls: offset, context, strand, meth), from one grouping.

    code is C with the base behind it, or C alone for all bases; strand is
    forward, reverse or both.
    """
    rows = calls.select(F.col(offset).alias(offset), F.substring("context", 2, 1).alias("base"), F.when(F.col("strand") == "-", "reverse").otherwise("forward").alias("strand"), "meth")
    o, b, s = (F.col(c) for c in (offset, "base", "strand"))
    out = rows.groupingSets([[o, b, s], [o, b], [o, s], [o]], o, b, s).agg(F.sum("meth").cast("long").alias("m"), F.sum(1 - F.col("meth")).cast("long").alias("u"), F.grouping("base").alias("all_bases"), F.grouping("strand").alias("both"))
    code = F.when(F.col("all_bases") == 1, "C").otherwise(F.concat(F.lit("C"), F.col("base")))
    return out.select(F.col(offset), code.alias("code"), F.when(F.col("both") == 1, "both").otherwise(F.col("strand")).alias("strand"), "m", "u", F.expr("try_divide(cast(m as double), m + u)").alias("level"))


def non_cg_bias(bias: DataFrame, offset: str = "offset") -> DataFrame:
    """The bias of CA, CC and CT together, as code CH."""
    out = bias.filter(F.col("code").isin("CA", "CC", "CT")).groupBy(offset, "strand").agg(F.sum("m").alias("m"), F.sum("u").alias("u"))
    return out.select(offset, F.lit("CH").alias("code"), "strand", "m", "u", F.expr("try_divide(cast(m as double), m + u)").alias("level"))


def level_by_coverage(sites: DataFrame) -> DataFrame:
    """Sites by tenth of level and class of coverage, with the share of those at that level or more."""
    pct = F.col("m").cast("double") / F.col("cov")
    cls = F.when(F.col("cov") <= 1, "0-1").when(F.col("cov") <= 5, "1-5").when(F.col("cov") <= 10, "5-10").when(F.col("cov") <= 20, "10-20").otherwise(">20")
    counts = sites.filter("cov > 0").groupBy(cls.alias("coverage"), F.least(F.floor(pct * 10 + 1e-9), F.lit(9)).cast("long").alias("decile")).agg(F.count("*").alias("n"))
    w = W.partitionBy("coverage")
    return counts.withColumn("share_above", F.sum("n").over(w.orderBy(F.desc("decile"))) / F.sum("n").over(w))


def histogram(rows: DataFrame, value, width: float, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts of values in bins of a width (bin: its number)."""
    return rows.groupBy(*by, F.floor(value / width + 1e-9).cast("long").alias("bin")).agg(F.count("*").alias("n"))
