"""Sequences read as chunks from FASTA files over several splits."""

import random
import time

import pytest

from cytolake.operators import alignment as al
from cytolake.sources import readers, sequences


def genome(n, seed):
    rng = random.Random(seed)
    return "".join(rng.choices("ACGTN", k=n))


def write(path, records, width, end="\n"):
    with open(path, "w", newline="") as file:
        for name, seq in records.items():
            file.write(f">{name} some words{end}")
            file.writelines(seq[i : i + width] + end for i in range(0, len(seq), width))
            file.write(end)


def expected_chunks(records, size, overlap, before):
    out = []
    for ref, seq in records.items():
        for k in range(-(-len(seq) // size)):
            start = max(0, k * size - before)
            out.append((ref, k, start, seq[start : k * size + size + overlap]))
    return sorted(out)


@pytest.mark.parametrize(("width", "end", "split"), [(60, "\n", 2000), (7, "\r\n", 331), (100_000, "\n", 5000)])
def test_chunks_over_splits(spark, tmp_path, width, end, split):
    """Records far longer than a split, shorter than one, of one base, and lines longer than a chunk."""
    one = {"chr1": genome(23_456, 1), "b": "A", "chr2": genome(1000, 2), "exact": genome(2000, 3), "last": genome(9001, 4)}
    two = {"other": genome(5000, 5)}
    write(tmp_path / "one.fa", one, width, end)
    write(tmp_path / "two.fa", two, width, end)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = sequences.fasta_chunks(spark, str(tmp_path), 500, 130, 16)
        assert got.select("ref").rdd.getNumPartitions() >= 1
        assert sorted(map(tuple, got.collect())) == expected_chunks(one | two, 500, 130, 16)
        assert {tuple(r) for r in sequences.sequence_lengths(got).collect()} == {(n, len(s)) for n, s in (one | two).items()}
        narrow = sequences.as_chunks(got, 500, 3, 0)
        assert sorted(map(tuple, narrow.collect())) == expected_chunks(one | two, 500, 3, 0)
        motifs = {(r["ref"], r["at"]) for r in al.motif_starts(got, "CCGG", 500).collect()}
        assert motifs == {(n, i) for n, s in (one | two).items() for i in range(len(s)) if s.startswith("CCGG", i)}
        fragments = al.digest(got, "CCGG", 1, 500).orderBy("start_pos").collect()
        for name, seq in (one | two).items():
            assert "".join(f["seq"] for f in fragments if f["ref"] == name) == seq
        assert {(r["ref"], r["seq"]) for r in readers.fasta(spark, str(tmp_path)).collect()} == set((one | two).items())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_odd_files(spark, tmp_path):
    (tmp_path / "odd.fa").write_text("no record yet\n>  spaced name\n\nAC GT\n  TT\n>empty\n>tail\nGG")
    assert sorted(map(tuple, sequences.fasta_chunks(spark, str(tmp_path / "odd.fa")).collect())) == [("spaced", 0, 0, "ACGTTT"), ("tail", 0, 0, "GG")]
    assert sequences.fasta_chunks(spark, str(tmp_path / "odd.fa"), full_header=True).filter("ref = 'spaced name'").count() == 1
    (tmp_path / "none.fa").write_text("")
    assert sequences.fasta_chunks(spark, str(tmp_path / "none.fa")).count() == 0
    (tmp_path / "twice.fa").write_text(">a\nAC\n>a\nGT\n")
    with pytest.raises(Exception, match="two sequences have the name a"):
        sequences.fasta_chunks(spark, str(tmp_path / "twice.fa")).collect()


def test_rows_as_chunks(spark):
    records = {"long": genome(23_456, 7), "exact": genome(1000, 8), "short": "ACG"}
    refs = spark.createDataFrame([*records.items()], "ref string, seq string")
    for size, overlap, before in ((500, 130, 16), (500, 0, 0), (50, 1000, 70), (100_000, 10, 10)):
        assert sorted(map(tuple, sequences.chunk_rows(refs, size, overlap, before).collect())) == expected_chunks(records, size, overlap, before)
    nothing = sequences.chunk_rows(spark.createDataFrame([("a", ""), ("b", None)], "ref string, seq string"))
    assert sorted(map(tuple, nothing.collect())) == [("a", 0, 0, ""), ("b", 0, 0, "")]


def test_cutting_takes_time_in_proportion(spark):
    def seconds(n):
        refs = spark.createDataFrame([("c", genome(1 << 16, 1) * (n >> 16))], "ref string, seq string").cache()
        refs.count()
        began = time.perf_counter()
        sequences.chunk_rows(refs).selectExpr("sum(length(bases))").collect()
        return time.perf_counter() - began

    seconds(1 << 20)
    assert seconds(20 << 20) < 8 * max(0.5, seconds(5 << 20))


def test_calls_from_chunks_equal_calls_from_rows(spark, tmp_path):
    bases = genome(6000, 9).replace("N", "C")
    write(tmp_path / "ref.fa", {"c": bases}, 60)
    rng = random.Random(3)
    reads = [(f"r{i}", 1, "C", 0, "c", at + 1, "50M", bases[at : at + 50].replace("C", "T") if i % 2 else bases[at : at + 50], "I" * 50) for i in range(300) for at in [rng.randrange(len(bases) - 50)]]
    table = spark.createDataFrame(reads, "qname string, mate int, mode string, flag int, ref string, pos long, cigar string, seq string, qual string")
    refs = spark.createDataFrame([("c", bases)], "ref string, seq string")
    one = al.call_methylation(table, refs, [("CCGG", "+", 2)]).collect()
    two = al.call_methylation(table, sequences.fasta_chunks(spark, str(tmp_path / "ref.fa")), [("CCGG", "+", 2)]).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))
    assert len(one) > 100
