"""Column functions over sequences, alignments and their tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: IUPAC codes (fixed values).
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "GC", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}
COMPLEMENT = ("ACGTRYKMBDHVacgtrykmbdhv", "TGCAYRMKVHDBtgcayrmkvhdb")


def convert(seq: Column, mode: str) -> Column:
    """Bisulfite conversion in silico: mode C turns T into C, mode G turns A into G; case stays."""
    return F.translate(seq, *{"C": ("Tt", "Cc"), "G": ("Aa", "Gg")}[mode.upper()])


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), *COMPLEMENT)


def expand_context(context: str) -> list[tuple[str, int]]:
    """All k-mers of an IUPAC context, with the offset of its C."""
    words = [""]
    for code in context.upper():
        words = [w + base for w in words for base in sorted(IUPAC[code])]
    return [(w, context.upper().index("C")) for w in words]


def cigar_sum(cigar: Column, ops: str) -> Column:
    """Sum of the lengths of these operations."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(f"([0-9]+)[{ops}]"), 1), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def md_mismatches(md: Column) -> Column:
    """Changed bases of an MD tag."""
    return F.length(F.regexp_replace(F.regexp_replace(md, r"\^[A-Za-z]+", ""), "[0-9]", ""))


def md_deletions(md: Column) -> Column:
    """Deleted bases of an MD tag."""
    return F.aggregate(F.regexp_extract_all(md, F.lit(r"\^([A-Za-z]+)"), 1), F.lit(0), lambda a, x: a + F.length(x))


def sam_tag(tags: Column, name: str) -> Column:
    """Value of a tag in the tab-separated optional fields."""
    value = F.regexp_extract(tags, rf"(?:^|\t){name}:[A-Za-z]:([^\t]*)", 1)
    return F.when(tags.rlike(rf"(?:^|\t){name}:[A-Za-z]:"), value)


def trim(seq: Column, five: int = 0, three: int = 0) -> Column:
    """Fixed trims at both ends, then runs of N at both ends."""
    cut = F.substring(seq, F.lit(five + 1), F.greatest(F.length(seq) - five - three, F.lit(0)))
    return F.regexp_replace(F.regexp_replace(cut, "^[Nn]+", ""), "[Nn]+$", "")


def quality_trim(seq: Column, qual: Column, five: int, three: int, offset: int = 33) -> Column:
    """(seq, qual) without the ends whose base qualities lie below the limits."""

    def below(limit: int) -> str:
        return "[" + "".join(f"\\x{{{c:02x}}}" for c in range(offset, offset + limit)) + "]" if limit > 0 else "(?!)"

    head = F.length(F.regexp_extract(qual, f"^({below(five)}*)", 1)) if five > 0 else F.lit(0)
    tail = F.length(F.regexp_extract(qual, f"({below(three)}*)$", 1)) if three > 0 else F.lit(0)
    size = F.greatest(F.length(qual) - head - tail, F.lit(0))
    return F.struct(F.substring(seq, head + 1, size).alias("seq"), F.substring(qual, head + 1, size).alias("qual"))


def trim_reads(reads: DataFrame, five: int = 0, three: int = 0, n_ends: bool = False, q5: int = 0, q3: int = 0, min_length: float = 0) -> DataFrame:
    """Reads (id, seq, plus, qual) after fixed trims, runs of N and ends of low quality, with `length` and `kept`.

    q5 and q3 are limits as characters of the quality string. A read is kept if
    it has `min_length` bases (above 1) or that share of its own (up to 1).
    """
    n = F.length("seq")
    lead = F.length(F.regexp_extract("seq", "^([Nn]*)", 1)) if n_ends else F.lit(0)
    trail = F.length(F.regexp_extract("seq", "([Nn]*)$", 1)) if n_ends else F.lit(0)
    left, right = F.greatest(F.lit(five), lead), F.least(n - three, n - trail)

    def low(limit: int) -> str:
        return "[" + "".join(f"\\x{{{c:02x}}}" for c in range(33, limit)) + "]" if limit > 33 else "(?!)"

    rows = reads.withColumns({"cut_at": left, "cut_size": F.greatest(right - left, F.lit(0))})
    middle = F.substring("qual", F.col("cut_at") + 1, F.col("cut_size"))
    head, tail = F.length(F.regexp_extract(middle, f"^({low(q5)}*)", 1)), F.length(F.regexp_extract(middle, f"({low(q3)}*)$", 1))
    rows = rows.withColumns({"whole": n, "cut_at": F.col("cut_at") + head, "length": F.greatest(F.col("cut_size") - head - tail, F.lit(0))})
    enough = F.col("length") >= min_length if min_length > 1 else F.col("length") >= min_length * F.col("whole")
    cut = {c: F.substring(c, F.col("cut_at") + 1, F.col("length")) for c in ("seq", "qual")}
    return rows.withColumns({**cut, "kept": enough}).drop("cut_at", "cut_size", "whole")


def two_genomes(refs: DataFrame) -> DataFrame:
    """A reference (ref, seq) converted both ways: genome c and genome g, to be written apart."""
    both = F.array(*[F.struct(F.lit(g).alias("genome"), convert(F.col("seq"), g.upper()).alias("seq")) for g in ("c", "g")])
    return refs.select("ref", F.explode(both).alias("x")).select("x.genome", "ref", "x.seq")


def base_quality(qual: Column, at: Column, offset: int = 33) -> Column:
    """Quality of the base at a place from 1."""
    return F.ascii(F.substring(qual, at, F.lit(1))) - offset


def limit_of(limit: str, length: Column) -> Column:
    """A limit written with a point is a share of the length, rounded half up; otherwise a number."""
    return F.floor(float(limit) * length + 0.5).cast("long") if "." in limit else F.lit(int(limit)).cast("long")


def item_rgb(p: Column) -> Column:
    """Colour of a level: red as it rises, green as it falls."""
    red = (F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)) * 255).cast("int")
    return F.concat_ws(",", red.cast("string"), (255 - red).cast("string"), F.lit("0"))


def phred_offset(low: Column, high: Column) -> Column:
    """Encoding of quality strings from their least and largest character codes."""
    return F.when(low < 59, 33).when(high > 74, 64).otherwise(33)
