"""Readers, writers, catalogs, the call path on hand-made reads, the batch plan and streams."""

import random

import pytest
from pyspark.sql import functions as F

from cytolake.functions import sequence as sq
from cytolake.operators import alignment as al
from cytolake.operators import intervals as iv
from cytolake.operators import sites as st
from cytolake.plans.batch import Settings, batch
from cytolake.sources import catalogs, readers, sequences, writers
from cytolake.streaming.windows import arriving_sites


def put(tmp_path, name, text):
    import gzip

    (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
    (tmp_path / name).write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
    return f"{tmp_path}/{name}"


def rows(df, *order):
    return sorted(map(tuple, df.collect()), key=lambda r: [str(r[k]) for k in order] if order else str(r))


def test_fastq_lines_follow_over_splits(spark, tmp_path):
    path = put(tmp_path, "a.fastq", "".join(f"@r{k} x\n{'ACGT' * (k % 5 + 1)}\n+\n{'IIII' * (k % 5 + 1)}\n" for k in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = readers.fastq(spark, path).orderBy("ord").collect()
        parts = writers.split_reads(readers.fastq(spark, path), 3).groupBy("part").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"), F.count("*").alias("n")).orderBy("lo").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r["ord"], r["id"], r["seq"], r["qual"]) for r in found] == [(k, f"r{k} x", "ACGT" * (k % 5 + 1), "IIII" * (k % 5 + 1)) for k in range(500)]
    assert sum(r["n"] for r in parts) == 500 and all(a["hi"] < b["lo"] for a, b in zip(parts, parts[1:], strict=False))


def test_fasta_sam_and_beds(spark, tmp_path):
    path = put(tmp_path, "g.fa.gz", ">chr1 first\nACGT\nAC\n>sp|P1|chr2 second\nGG\n")
    assert rows(readers.fasta(spark, path)) == [("chr1", "ACGTAC"), ("sp|P1|chr2", "GG")]
    assert {r["name"] for r in readers.fasta_records(spark, path, "sp").collect()} == {"", "P1"}
    assert sorted(r["name"] for r in readers.fasta_records(spark, path, "no").collect()) == ["1", "2"]
    assert {r["name"] for r in readers.fasta_records(spark, path, "last").collect()} == {"", "chr2"}
    assert rows(sq.two_genomes(readers.fasta(spark, path))) == [("c", "chr1", "ACGCAC"), ("c", "sp|P1|chr2", "GG"), ("g", "chr1", "GCGTGC"), ("g", "sp|P1|chr2", "GG")]
    sam = put(tmp_path, "x.sam", "@HD\tVN:1\nq/1\t16\tchr1\t3\t30\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:1\tZT:Z:C\nq2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\n")
    found = readers.sam(spark, sam).orderBy("qname").collect()
    assert [(r["qname"], r["flag"], r["pos"], r["tags"]) for r in found] == [("q/1", 16, 3, "NM:i:1\tZT:Z:C"), ("q2", 4, 0, "")]
    fq = readers.fastq(spark, put(tmp_path, "o.fastq", "@z\nA\n+\nI\n@q/1 more\nACGT\n+\nIIII\n"))
    assert rows(al.in_read_order(readers.sam(spark, sam), fq).select("qname", "ord", "original")) == [("q/1", 1, "ACGT")]
    put(tmp_path, "beds/s1.x.CG.bed", "chr1\t0\t2\t10\t0.5\t+\t5\n")
    put(tmp_path, "beds/s2.CG.bed.gz", "#c\nchr1\t0\t2\t4\t0.25\t+\t1\n")
    put(tmp_path, "beds/s3.CHG.bed", "chr1\t0\t2\t4\t0.25\t+\t1\n")
    assert rows(readers.site_beds(spark, f"{tmp_path}/beds", "CG").select("sample", "cov", "m")) == [("s1", 10, 5), ("s2", 4, 1)]
    messy = put(tmp_path, "m.bed", "track name=x\nbrowser y\nchr1\t5\t9\tn\t0\t+\textra\nchr2\t1\t2\tm\t1\t-\tmore\n")
    assert readers.clean_bed(spark, messy).columns == ["chrom", "start", "end", "name", "score", "strand"]
    assert readers.clean_bed(spark, messy, True).count() == 2
    headed = put(tmp_path, "h.bed", "Chr\tstart\tend\nchr1\t5\t9\n")
    assert readers.clean_bed(spark, headed).columns == ["Chr", "start", "end"] and rows(readers.clean_bed(spark, headed)) == [("chr1", 5, 9)]
    probes = put(tmp_path, "p.txt", "#h\nchr1\t5\n\nchr1\t1\n")
    assert rows(readers.numbered_probes(spark, probes, "ref string, start_pos long")) == [(1, "chr1", 5), (2, "chr1", 1)]


def test_sheets_and_matrices(spark, tmp_path):
    sheet = put(tmp_path, "s.txt", "a.fq\t1\tS1\tMU\nb.fq\t2\tS1\tMU\nS1\tS2\tpair\tMU\n")
    samples, pairs = readers.sample_sheet(spark, sheet)
    assert rows(samples) == [("a.fq", 1, "S1", "MU"), ("b.fq", 2, "S1", "MU")] and rows(pairs) == [("S1", "S2", "pair", "MU")]
    for name in ("MU1_R1.fastq.gz", "MU1_R2.fastq.gz", "MCG2.fq", "notes.txt"):
        put(tmp_path, f"fq/{name}", "@a\nA\n+\nI\n")
    made = readers.make_sample_sheet(spark, f"{tmp_path}/fq", [("MU", "Cancer"), ("MCG", "Normal")])
    assert rows(made.select("sample", "mode", "grp")) == [("MCG2", 1, "Normal"), ("MU1", 1, "Cancer"), ("MU1", 2, "Cancer")]
    one = put(tmp_path, "m1", "#Ref\tStart\tEnd\tKO1\tWT1\nchr1\t3010894\t3010896\t0.684\tNA\n")
    assert rows(readers.joined_matrix(spark, one)) == [("chr1", "3010894", "3010896", "KO1", 0.684), ("chr1", "3010894", "3010896", "WT1", None)]
    two = put(tmp_path, "m2", "#Ref\tStart\tEnd\tKO1\tKO1\tWT1\tWT1\nchr1\t1\t3\t6\t19\t2\t10\n")
    assert rows(readers.joined_matrix(spark, two).select("sample", "m", "cov")) == [("KO1", 6.0, 19.0), ("WT1", 2.0, 10.0)]
    means = put(tmp_path, "m3", "#Ref\tStart\tEnd\tKO1\tKO1\tKO1\nchr1\t1\t201\t1\t0.684\t0.0\n")
    counts = put(tmp_path, "m4", "#Ref\tStart\tEnd\tKO1\tKO1\tKO1\nchr1\t1\t201\t1\t13\t19\n")
    assert readers.joined_matrix(spark, means).columns[-2:] == ["mean_pct", "sd_pct"] and readers.joined_matrix(spark, counts).columns[-2:] == ["m", "cov"]
    wide = spark.createDataFrame([("chr1", 496, 498, 94.0, 95.0), ("chr1", 500, 502, None, 1.0)], "ref string, start_pos long, end_pos long, a double, b double")
    lines = [r["line"] for r in writers.gct_rows(wide, ["a", "b"]).orderBy("line_no").collect()]
    assert lines == ["#1.2", "1\t2", "NAME\tDescription\ta\tb", "chr1*496*498\tchr1\t94.0\t95.0"]
    writers.split_by_key(wide.select("ref", "start_pos", "a"), "ref", f"{tmp_path}/split", spark.createDataFrame([("chr2",)], "ref string"))
    assert rows(spark.read.option("sep", "\t").option("header", True).csv(f"{tmp_path}/split").select("start_pos", "a")) == [("496", "94.0"), ("500", "NA")]
    files = spark.createDataFrame([("a.bam",), ("x.met.bw",), ("odd.txt",)], "name string")
    assert [r["line"] for r in writers.track_lines(files, "http://h").orderBy("name").collect()] == ['track name="a.bam" type=bam bigDataUrl=http://h/a.bam', 'track name="x.met.bw" type=bigWig viewLimits=0:1 bigDataUrl=http://h/x.met.bw']
    counts = spark.createDataFrame([("chr1", 7, 3, 1, 90, 30, 0.75)], "ref string, pos long, m long, u long, mqual long, uqual long, score double")
    assert rows(writers.call_gff(counts, "CG"))[0][-4:] == ("0.750", "+", ".", "mread=3;uread=1;mqual=90;uqual=30")


def test_catalogs(spark, tmp_path):
    put(tmp_path, "home/conf/ref.conf", "#x\ngenome\tg.fa\nlength\tg.len\nindex_c\tbowtie\tg.c\nindex_g\tbowtie\tg.g\n")
    path = catalogs.find_file(spark, "ref.conf", [f"{tmp_path}/none", f"{tmp_path}/home/conf", f"{tmp_path}/home"])
    assert catalogs.reference_catalog(spark, path) == {"files": {"genome": "g.fa", "length": "g.len"}, "indexes": {"bowtie": {"c": "g.c", "g": "g.g"}}}
    with pytest.raises(FileNotFoundError):
        catalogs.find_file(spark, "other.conf", [f"{tmp_path}/home"])
    put(tmp_path, "db/genes.txt", "0\tg1\tchr1\t+\t1000\t2000\t1100\t1900\t2\t1000,1500,\t1200,2000,\n0\tg2\tchr1\t-\t5000\t6000\t5100\t5900\t1\t5000,\t6000,\n")
    put(tmp_path, "db/islands.txt", "chr1\t900\t1100\ti1\n")
    conf = put(tmp_path, "f.conf", "genes.txt\tgenes\tT\t2\t.\tT\tT\t3\t5\t6\t4\t500\t.\t.\t10\t11\t7\t8\t.\nislands.txt\tislands\tF\t4\t.\tF\tF\t1\t2\t3\t.\t100\t100\n")
    genes, islands = catalogs.feature_catalog(spark, conf)
    assert (genes["chrom"], genes["strand"], genes["up"], genes["down"], genes["exon_start"], genes["is_gene"]) == (3, 4, 500, 2000, 10, True)
    assert (islands["exon_start"], islands["strand"], islands["is_gene"]) == (None, None, False)
    table = readers.feature_table(spark, f"{tmp_path}/db/genes.txt", genes)
    sets = catalogs.feature_sets(table, genes)
    assert list(sets) == ["genes", "genesup", "genesdn"]
    assert rows(sets["genesup"].select("feature_id", "f_start", "f_end")) == [("g1", 500, 1000), ("g2", 6000, 6500)]
    assert rows(sets["genesdn"].select("feature_id", "f_start", "f_end")) == [("g1", 2000, 4000), ("g2", 3000, 5000)]
    sites = spark.createDataFrame([("chr1", 700, 702), ("chr1", 1500, 1502), ("chr1", 6200, 6202), ("chr1", 90000, 90002)], "ref string, start_pos long, end_pos long")
    found = {(r["set_name"], r["start_pos"]): r["label"] for r in catalogs.annotate(spark, sites, [genes, islands], f"{tmp_path}/db").collect()}
    assert found[("genes", 700)] == "upstream+" and found[("genes", 1500)] == "CDS+" and found[("genes", 6200)] == "upstream-" and found[("genes", 90000)] == "intergenic"
    assert found[("islands", 1500)] == "fardown" and len(found) == 8
    assert readers.enzyme_config(["# x", "name MspI", "site C-CGG", "fix CCGG + 2", "fix CCGG - 3"]) == {"fix": [("CCGG", "+", 2), ("CCGG", "-", 3)], "name": "MspI", "motif": "CCGG", "cut": 1}


@pytest.mark.parametrize("strand", ["+", "-"])
def test_gene_labels_follow_the_strand(spark, strand):
    """A gene of 1000 to 2000 with exons 1000-1200 and 1500-2000, coding from 1100 to 1900; sites by where they lie along the strand."""
    from cytolake.operators import annotation as an

    gene = (1000, 2000, strand, [(1000, 1200), (1500, 2000)], 1100, 1900)
    along = {"farup": (600, 700), "upstream": (700, 720), "start": (990, 1010), "utr": (1020, 1030), "turn": (1090, 1110), "coding": (1110, 1120), "intron": (1300, 1310), "end": (1990, 2010), "downstream": (2050, 2060), "fardown": (2100, 2110)}
    expected = {"farup": {"farup"}, "upstream": {"upstream"}, "start": {"upstream", "5UTR", "exon"}, "utr": {"5UTR", "exon"}, "turn": {"5UTR", "CDS", "exon"}, "coding": {"CDS", "exon"}, "intron": {"intron"}, "end": {"3UTR", "exon", "downstream"}, "downstream": {"downstream"}, "fardown": {"fardown"}}
    mirror = lambda a, b: (a, b) if strand == "+" else (3000 - b, 3000 - a)
    if strand == "-":
        gene = (1000, 2000, "-", [(1000, 1500), (1800, 2000)], 1100, 1900)
    table = spark.createDataFrame([(name, *mirror(*at), *gene) for name, at in along.items()], "name string, start_pos long, end_pos long, f_start long, f_end long, strand string, exons array<struct<s: long, e: long>>, cds_start long, cds_end long")
    found = {}
    for r in an.gene_labels(table, 300, 100).collect():
        found.setdefault(r["name"], []).append(r["label"])
    assert {k: set(v) for k, v in found.items()} == expected
    assert all(len(v) == len(set(v)) for v in found.values())
    plain = {(r["name"], r["label"]) for r in an.gene_labels(table.drop("exons"), 300, 100).collect()}
    assert {n for n, x in plain if x == "body"} == {"start", "utr", "turn", "coding", "intron", "end"}
    assert ("start", "upstream") in plain
    none = {(r["name"], r["label"]) for r in an.gene_labels(table.withColumn("exons", F.lit(None).cast("array<struct<s: bigint, e: bigint>>")), 300, 100).collect()}
    assert none == plain


def plain_score(mode, cigar, seq, bases):
    import re

    base, turned = ("C", "T") if mode == "C" else ("G", "A")
    at = i = errors = clip = skip = 0
    meth, un, md, run = [], [], "", 0
    for n, op in re.findall(r"(\d+)([MIDNSH])", cigar):
        for _ in range(int(n)):
            if op == "M":
                r, q = bases[at], seq[i]
                if r == q or (r == base and q == turned):
                    run += 1
                    (meth if r == q else un).append(at + 1) if r == base else None
                else:
                    errors, md, run = errors + 1, f"{md}{run}{r}", 0
                at, i = at + 1, i + 1
            elif op == "I":
                errors, i = errors + 1, i + 1
            elif op == "N":
                at, skip = at + 1, skip + 1
            elif op in "SH":
                clip, i = clip + 1, i + (op == "S")
        if op == "D":
            errors, md, run, at = errors + int(n), f"{md}{run}^{bases[at : at + int(n)]}", 0, at + int(n)
    return errors, clip, skip, f"{md}{run}", meth, un


def test_reads_are_scored_as_base_by_base(spark):
    rng = random.Random(3)
    genome = "".join(rng.choice("ACGT") for _ in range(600))
    reads, expected = [], {}
    for k, cigar in enumerate(["20M", "5S15M", "8M2I10M", "8M3D9M", "6M50N6M", "3S5M1I4M2D6M4S", "2H10M", "1M1D1M1I1M"] * 6):
        ops = [(int(n), op) for n, op in __import__("re").findall(r"(\d+)([MIDNSH])", cigar)]
        start, mode = rng.randrange(0, 500), rng.choice("CG")
        at, seq = start, ""
        for n, op in ops:
            if op == "M":
                part = [b if rng.random() < 0.9 else rng.choice("ACGT") for b in genome[at : at + n]]
                seq += "".join(("T" if b == "C" else "A") if b == mode and rng.random() < 0.5 else b for b in part)
            elif op in "IS":
                seq += "".join(rng.choice("ACGT") for _ in range(n))
            at += n if op in "MDN" else 0
        reads.append((f"r{k}", 1, mode, 0, "c", start + 1, cigar, seq, "".join(chr(33 + j) for j in range(len(seq)))))
        expected[f"r{k}"] = plain_score(mode, cigar, seq, genome[start:])
    table = spark.createDataFrame(reads, "qname string, mate int, mode string, flag int, ref string, pos long, cigar string, seq string, qual string")
    refs = spark.createDataFrame([("c", genome)], "ref string, seq string")
    scored = al.rescore(table, sequences.chunk_rows(refs, 100, 200), 100)
    assert {r["qname"]: (r["errors"], r["clip"], r["skip"], r["md"], r["ym"], r["yu"]) for r in scored.collect()} == expected
    for c in al.calls_of(scored).collect():  # the quality tells the place in the read
        read = reads[int(c["qname"][1:])]
        base = read[7][c["baseq"]]
        assert base == (read[2] if c["meth"] else {"C": "T", "G": "A"}[read[2]])
    assert rows(al.inconsistent(spark.createDataFrame([("a", 3, 1, 1, 1), ("b", 3, 1, 1, 0)], "qname string, nm int, mism int, ins int, del int")).select("qname")) == [("b",)]


@pytest.mark.parametrize("motif", ["CCGG", "GCGC", "AA"])
def test_motifs_and_digests_over_chunks(spark, motif):
    rng = random.Random(5)
    genomes = {f"c{k}": "".join(rng.choice("ACGT" if k else "AC") for _ in range(997)) for k in range(3)} | {"short": "AC", "hit": motif}
    refs = spark.createDataFrame(list(genomes.items()), "ref string, seq string")
    found, expected = rows(al.motif_starts(refs, motif, 50)), []
    for name, seq in genomes.items():
        at = seq.find(motif)
        while at >= 0:
            expected.append((name, at))
            at = seq.find(motif, at + len(motif))
    assert found == sorted(expected, key=str)
    pieces = al.digest(refs, motif, 1, 50).orderBy("ref", "start_pos").collect()
    for name, seq in genomes.items():
        assert "".join(p["seq"] for p in pieces if p["ref"] == name) == seq
    assert len(pieces) == len(genomes) + len(expected)


def test_filled_ends_follow_mode_clip_base_and_strand(spark):
    """The motif CCGG stands at 10 (from 0); rules fix its second base forward and its third reverse: places 12 and 13 from 1."""
    fixes = spark.createDataFrame([("c", 12, "+"), ("c", 13, "-")], "ref string, pos long, strand string")
    read = lambda q, mode, flag, pos, cigar, seq: (q, 1, mode, flag, "c", pos, cigar, seq)
    table = [read("ends there", "C", 0, 3, "10M", "AAAAAAAAAC"), read("ends one further", "C", 0, 4, "10M", "AAAAAAAACA"), read("goes on", "C", 0, 6, "10M", "AAAAAACAAA"), read("clipped", "C", 0, 3, "10M3S", "AAAAAAAAACAAA"), read("other base", "C", 0, 3, "10M", "AAAAAAAAAT"), read("begins there", "G", 16, 13, "10M", "GAAAAAAAAA"), read("begins one before", "G", 16, 12, "10M", "AGAAAAAAAA"), read("forward", "G", 0, 13, "10M", "GAAAAAAAAA")]
    filled = al.filled_calls(spark.createDataFrame(table, "qname string, mate int, mode string, flag int, ref string, pos long, cigar string, seq string"), fixes)
    assert rows(filled.select("qname", "offset")) == [("begins one before", 2), ("begins there", 1), ("ends one further", 9), ("ends there", 10)]
    assert rows(al.fill_in_log(filled)) == [("c", 12, 2), ("c", 13, 2)]


def test_filled_ends_of_reads_with_indels_and_clips(spark):
    """The reference is C at 12 forward; each read ends there, with an insertion, a deletion or a clip before. Their calls at 12 go, the others stay."""
    genome = "AAACAACAAACCAAAAAAAA"  # places from 1; C at 4, 7, 11, 12
    fixes = spark.createDataFrame([("c", 12, "+")], "ref string, pos long, strand string")
    read = lambda q, pos, cigar, seq: (q, 1, "C", 0, "c", pos, cigar, seq, "I" * len(seq))
    table = [read("plain", 3, "10M", "ACAACAAACC"), read("inserted", 3, "5M2I5M", "ACAACTTAAACC"), read("deleted", 3, "3M2D5M", "ACACAAACC"[:3] + "AAACC"), read("clipped before", 3, "2S10M", "TTACAACAAACC"), read("ends in an insertion", 3, "10M2I", "ACAACAAACCCC"), read("clipped behind", 3, "10M2S", "ACAACAAACCCC")]
    reads = spark.createDataFrame(table, "qname string, mate int, mode string, flag int, ref string, pos long, cigar string, seq string, qual string")
    chunks = sequences.chunk_rows(spark.createDataFrame([("c", genome)], "ref string, seq string"))
    calls = al.calls_of(al.rescore(reads, chunks))
    filled = al.filled_calls(reads, fixes)
    left = al.drop_filled_ends(calls, filled)
    gone = {(r["qname"], r["pos"]) for r in calls.collect()} - {(r["qname"], r["pos"]) for r in left.collect()}
    assert gone == {("plain", 12), ("inserted", 12), ("deleted", 12), ("clipped before", 12)}
    assert calls.count() - left.count() == 4
    table = spark.createDataFrame([("3S4M2I3M2D5M1S",)], "cigar string")
    spans = [r[0] for r in table.select(F.explode(F.sequence(F.lit(1), F.lit(18))).alias("k"), "cigar").select(al.span_offset(F.col("cigar"), F.col("k"))).collect()]
    assert spans == [None, None, None, 1, 2, 3, 4, None, None, 5, 6, 7, 10, 11, 12, 13, 14, None]


def test_calls_in_one_pass_equal_calls_step_by_step(spark):
    """Indels, clips, low qualities, ends of sequences and chunks, filled-in ends: the pass over the reads counts what the steps count."""
    rng = random.Random(11)
    genome = "".join(rng.choice(["CCGG", "A", "C", "G", "T"]) for _ in range(400))
    reads = []
    for k in range(400):
        cigar = rng.choice(["20M", "3S17M", "8M2I10M", "8M3D9M", "6M20N6M", "12M2S", "2H10M"])
        start, mode, at, seq = rng.choice([0, len(genome) - 40, rng.randrange(len(genome) - 60)]), rng.choice("CG"), 0, ""
        for n, op in __import__("re").findall(r"(\d+)([MIDNSH])", cigar):
            part = genome[start + at : start + at + int(n)]
            seq += "".join(("T" if b == "C" else "A") if b == mode and rng.random() < 0.5 else b for b in part) if op == "M" else "".join(rng.choice("ACGT") for _ in range(int(n))) if op in "IS" else ""
            at += int(n) if op in "MDN" else 0
        reads.append((f"r{k}", 1, mode, rng.choice([0, 16]), "c", start + 1, cigar, seq, "".join(rng.choice("+5I") for _ in seq)))
    table = spark.createDataFrame(reads, "qname string, mate int, mode string, flag int, ref string, pos long, cigar string, seq string, qual string")
    refs = spark.createDataFrame([("c", genome)], "ref string, seq string")
    fixes = [("CCGG", "+", 2), ("CCGG", "-", 3)]
    for rules in (None, fixes):
        chunks = sequences.as_chunks(refs, 100)
        calls = al.calls_of(al.rescore(table, chunks, 100), 20)
        if rules:
            calls = al.drop_filled_ends(calls, al.filled_calls(table, al.fix_places(refs, rules)))
        steps = st.pileup(al.call_contexts(calls, chunks, 3, 100), 20, ("ref", "pos", "strand", "context"))
        found = al.call_methylation(table, refs, rules, 20, 3, 100)
        assert rows(found) == rows(steps.select(found.columns)) and found.count() > 100


def test_laid_reads_take_time_in_proportion_to_their_sequence(spark):
    """A sequence is cut in one pass; when each read took all of it along, ten times the length took a hundred times as long."""
    import time

    from cytolake.queries import reads as queries

    def seconds(n):
        own = queries.dna
        queries.dna = lambda *_: spark.range(1).select(F.lit("d").alias("doc_id"), F.expr(f"repeat('ACGTTGCA', {n})").alias("seq"))
        try:
            began = time.perf_counter()
            assert queries.laid(spark, "")[0].selectExpr("count(seq)", "sum(length(seq))").first()[0] == n // 5
            return time.perf_counter() - began
        finally:
            queries.dna = own

    seconds(10_000)
    assert seconds(200_000) < 60


def test_nearest_features_equal_brute_force(spark):
    rng = random.Random(2)
    features = [(k, f"c{k % 2}", s, s + rng.randint(1, 400), rng.choice("+-")) for k in range(60) for s in [rng.randrange(0, 5_000_000)]] + [(100, "c0", 1000, 1100, "+"), (101, "c0", 900, 1100, "-"), (102, "c0", 1400, 1500, "+")]
    queries = [(f"c{k % 3}", s, s + rng.randint(1, 50)) for k in range(120) for s in [rng.randrange(0, 5_200_000)]] + [("c0", 1249, 1250), ("c0", 1050, 1051), ("c0", 1050, 1051)]
    f = spark.createDataFrame(features, "feature_id long, ref string, f_start long, f_end long, strand string")
    q = spark.createDataFrame(queries, "ref string, start_pos long, end_pos long")
    far = lambda s, e, b, t: 0 if s < t and b < e else s - t + 1 if t <= s else e - b - 1
    for allow, stranded in ((0, False), (300, False), (0, True)):
        expected = set()
        for ref, s, e in set(queries):
            for sides in (["+"], ["-"]) if stranded else (["+", "-"],):
                dist = [(far(s, e, x[2], x[3]), x[0]) for x in features if x[1] == ref and x[4] in sides]
                expected |= {(ref, s, e, i, d) for d, i in dist if abs(d) == min(abs(y) for y, _ in dist) or abs(d) <= allow}
        found = iv.nearest_join(q, f, allow, stranded).select("ref", "start_pos", "end_pos", "feature_id", "dist").collect()
        assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def site_table(spark):
    rng = random.Random(7)
    data = [(f"{g}{k}", g, "chr1", p * 40, p * 40 + 2, 20, min(20, max(0, round(20 * (0.8 if g == "a" and p < 100 else 0.3)) + rng.randint(-3, 3)))) for g in "ab" for k in range(3) for p in range(300)]
    return spark.createDataFrame(data, "sample string, grp string, ref string, start_pos long, end_pos long, cov long, m long")


def test_batch_runs_and_resumes(spark, tmp_path):
    sites = site_table(spark)
    features = spark.createDataFrame([(1, "chr1", 0, 3000, "+"), (2, "chr1", 8000, 9000, "-")], "feature_id long, ref string, f_start long, f_end long, strand string")
    settings, samples = Settings(pairs=[("a", "b")]), ["a0", "a1", "a2", "b0", "b1", "b2"]
    out = batch(sites, features, settings, str(tmp_path), samples)
    assert set(out) == {"windows", "matrix", "tests", "annotated"}
    hits = {r["start_pos"] for r in out["annotated"].collect()}
    assert hits and max(hits) <= 4000 and 0 in hits  # the windows in which the groups differ
    before = {k: rows(v) for k, v in out.items()}
    marks = {k: v.inputFiles() for k, v in out.items()}
    again = batch(sites.repartition(3), features, settings, str(tmp_path), samples, resume=True)
    assert {k: v.inputFiles() for k, v in again.items()} == marks  # read, not made anew
    assert {k: rows(v) for k, v in again.items()} == before
    changed = batch(sites.filter("start_pos >= 500"), features, settings, str(tmp_path), samples, resume=True)
    assert rows(changed["windows"]) != before["windows"]
    other = batch(sites, features, Settings(pairs=[("a", "b")], width=2000), str(tmp_path), samples, resume=True)
    assert rows(other["windows"]) != before["windows"]


def test_regions_come_out_when_reads_have_passed_them(spark, tmp_path):
    """Sorted calls in files of one batch each: all counts equal the batch's and come once, regions that were passed before others arrive, late calls don't count."""
    from cytolake.operators.sites import pileup
    from cytolake.streaming.regions import end_of_order, region_pileup

    rng, order, schema = random.Random(7), ["chr1", "chr2"], "ref string, pos long, meth int, baseq int"
    table = sorted((order[i % 2], rng.randint(1, 5000), rng.randint(0, 1), rng.randint(0, 40)) for i in range(3000))
    end = (*end_of_order(order), 1, 40)
    late = ("chr1", 10, 1, 40)
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    seen = []
    for k, part in enumerate([table[:1000], table[1000:2000], table[2000:], [late], [end], [end]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        run = region_pileup(stream, order, 500, 100, 5).writeStream.outputMode("append").format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
        run.awaitTermination(120)
        done = spark.read.parquet(out)
        seen.append((done.count(), done.filter("ref = 'chr1'").agg(F.max("pos")).first()[0]))
        if k == 0:
            assert seen[0][1] <= max(r[1] for r in table[:1000]) - 100
    assert seen[0][0] < seen[1][0] < seen[2][0] == seen[3][0] < seen[4][0]
    expected = pileup(spark.createDataFrame(table, schema), 5).select("ref", "pos", "m", "u", "mqual", "uqual")
    assert rows(spark.read.parquet(out).select("ref", "pos", "m", "u", "mqual", "uqual")) == rows(expected)


def test_fingerprints_follow_files_and_rows(spark, tmp_path):
    from cytolake.plans.tables import fingerprint

    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    first = fingerprint(spark.read.parquet(path).filter("id > 3"))
    assert first == fingerprint(spark.read.parquet(path).filter("id > 3"))
    assert first != fingerprint(spark.read.parquet(path).filter("id > 4"))
    spark.range(10).write.mode("append").parquet(path)
    assert first != fingerprint(spark.read.parquet(path).filter("id > 3"))
    table = lambda *ids: spark.createDataFrame([(i, None) for i in ids], "id long, x string")
    assert fingerprint(table(1, 2)) == fingerprint(table(2, 1)) != fingerprint(table(1, 3))
    assert fingerprint(table(1, 1)) != fingerprint(table(1))
    assert fingerprint(table(1)) != fingerprint(table(1).union(spark.read.parquet(path).withColumn("x", F.lit("a"))))


def test_arriving_sites_add_up_to_the_batch(spark, tmp_path):
    sites = site_table(spark).withColumn("arrived", F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(start_pos % 5 as int)) "))
    sites.repartition(3).write.parquet(f"{tmp_path}/in")
    late = sites.limit(1).withColumn("arrived", F.expr("timestamp'2024-01-05 00:00:00'")).withColumn("ref", F.lit("end"))
    late.write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(sites.schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/in")
    run = arriving_sites(stream, 1000, 500).writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
    run.awaitTermination(120)
    keys = ["sample", "ref", "w_start", "w_end"]
    found = spark.read.parquet(f"{tmp_path}/out").groupBy(*keys).agg(F.sum("n_cpg").alias("n"), F.sum("m").alias("m"), F.sum("cov").alias("cov"))
    expected = iv.sliding_windows(sites, 1000, 500).groupBy(*keys).agg(F.count("*").alias("n"), F.sum("m").alias("m"), F.sum("cov").alias("cov"))
    assert rows(found) == rows(expected)
