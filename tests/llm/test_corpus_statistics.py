"""Divergence of sources, phrases and byte-level BPE against brute force and the tokenizers library, on small tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from cytolake.llm import bpe, divergence, phrases

RNG = random.Random(11)
#: Null, empty and odd texts, languages and sources, and repeated rows.
ODD = [(None, None, None, None), (1, "en", "a", None), (2, "en", None, ""), (3, "en", "a", " \n\t ..!"), (4, None, "b", "one"), (5, "x\0y", "a", "é😀 \x1c x\x00y <|endoftext|>"), (6, "en", "a", "Same row."), (6, "en", "a", "Same row."), (7, "en", "a", "word " * 3000), (8, "de", "", "x" * 50000), (9, "", "", "An é é, é é; AN é")]


def made(n, seed, langs=("en", "en", "en", "de"), sources=11):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "a", "of", "Rose", "straße", "b1b", "z"]
    text = lambda: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", ", ", ".\n", "\t", "-"]) for _ in range(rng.randint(0, 40)))
    return [(i, rng.choice(langs), f"s{rng.randrange(sources)}", text()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", "t") for r in rows], "doc_id long, lang string, source string, text string, n int, phrase string, term string")


def expected_phrases(rows, longest, least, share, top):
    counts, totals = Counter(), Counter()
    for _, lang, _, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), a in candidates.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                if 100 * a >= share * candidates[lang, words[i : i + m]]:
                    dropped.add((lang, words[i : i + m]))
    found = {}
    for (lang, words), a in candidates.items():
        if (lang, words) not in dropped:
            cuts = [(1000 * a * totals[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return {(lang, i, p.decode(), -a, left, right, totals[lang], -score) for lang, all_found in found.items() for i, (score, a, p, left, right) in enumerate(sorted(all_found)[:top], 1)}


@pytest.mark.parametrize(("hot_share", "share", "top", "longest"), [(1 / 2000, 100, 2000, 5), (0.02, 100, 2000, 5), (0.5, 60, 7, 3)])
def test_phrases_equal_brute_force(spark, monkeypatch, hot_share, share, top, longest):
    monkeypatch.setattr(phrases, "HOT_SHARE", hot_share)
    rows = ODD + made(400, 3) + [(1, lang, "a", "a rose is. a rose is") for lang in ("en", "e n", "e%20n", "e%2520n", "en ", "") for _ in range(9)]
    got = phrases.strongest_phrases(frame(spark, rows).repartition(3), longest=longest, least=4, share=share, top=top).collect()
    assert {tuple(r) for r in got} == expected_phrases(rows, longest, 4, share, top)
    assert len(got) == len({tuple(r) for r in got})


def test_hot_words_are_dealt_out(spark):
    hot = phrases.hot_prefixes(frame(spark, [(i, "en", "a", f"the {i} rose") for i in range(3000)]), 5)
    own = phrases.lang_hash("en")
    one = phrases.Suffixes(np.frombuffer(b"the other", np.uint8), np.array([0, 9]), 5).hashes[0]
    assert phrases.mix(one[0] ^ own) in hot
    assert phrases.mix(one[1] ^ own) not in hot


def test_phrases_of_nothing(spark):
    assert phrases.strongest_phrases(frame(spark, [])).count() == 0
    assert phrases.strongest_phrases(frame(spark, ODD), least=10_000).count() == 0


def test_same_words_of_neighbours():
    import pyarrow as pa

    rng = random.Random(4)
    values = sorted([b"".join(rng.choice([b"a ", b"ab ", b"longer-than-eight ", b"y" * 700 + b" "]) for _ in range(rng.randint(1, 5))) for _ in range(300)], reverse=True)
    same, size = phrases.same_words(pa.array(values, pa.binary()).slice(1))
    for i in range(2, len(values)):
        a, b = values[i].split(), values[i - 1].split()
        assert same[i - 1] == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert size[i - 1] == len(a)


def chance(count, total, terms):
    return 1 + 10**9 * (count + 1) // (total + terms)


def expected_audit(rows, least_docs, top):
    cells, docs, groups = Counter(), Counter(), set()
    for _, lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        docs.update((lang, t) for t in set(terms))
        cells.update((lang, source, t) for t in terms)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least_docs]
        sources = [s for x, s in groups if x == lang]
        p = {}
        for s in [*sources, None]:
            counts = [sum(cells[lang, y, t] for y in (sources if s is None else [s])) for t in kept]
            p[s] = {t: (chance(c, sum(counts), len(kept)), c) for t, c in zip(kept, counts, strict=True)}
        gap = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = sorted((-sum(gap(p[s][t][0], p[o][t][0]) for t in kept), o.encode()) for o in sources if o != s)
            best = sorted((-gap(p[s][t][0], p[None][t][0]), t.encode()) for t in kept if p[s][t][1] and p[s][t][0] > p[None][t][0])[:top]
            out |= {(lang, s, part, o.decode(), -v, i) for part, found in (("pair", pairs), ("term", best)) for i, (v, o) in enumerate(found, 1)}
    return out


@pytest.mark.parametrize(("least_docs", "top", "slice_size"), [(3, 200, 8192), (1, 4, 2)])
def test_audit_equals_brute_force(spark, monkeypatch, least_docs, top, slice_size):
    monkeypatch.setattr(divergence, "TERMS", slice_size)
    rows = ODD + made(300, 5) + [(i, "de", f"only{i % 3}", "nur hier") for i in range(4)] + [(0, "none", s, f"unlike {s}") for s in "abcdefghi"]
    got = divergence.audit_sources(frame(spark, rows).repartition(3), least_docs, top).collect()
    assert {tuple(r) for r in got} == expected_audit(rows, least_docs, top)
    assert len(got) == len({tuple(r) for r in got})


def test_audit_of_nothing(spark):
    assert divergence.audit_sources(frame(spark, [])).count() == 0


def test_every_pair_of_seats_meets_once(spark):
    from pyspark.sql import functions as F

    for seats in (2, 6, 10):
        met = Counter()
        for turn in range(seats - 1):
            table = spark.range(seats).select("id", divergence.partner(F.col("id").cast("int"), F.lit(seats), turn).alias("other")).collect()
            assert {r["other"] for r in table} == set(range(seats))
            met.update((r["id"], r["other"]) for r in table if r["other"] < r["id"])
        assert met == Counter({(i, j): 1 for i in range(seats) for j in range(i)})


def test_chances_are_exact():
    counts = [0, 1, 10**10, 3 * 10**12, 9 * 10**12]
    total = sum(counts) + 7
    assert divergence.chances(np.array(counts), total, 12345).tolist() == [chance(c, total, 12345) for c in counts]


def test_vectors_round_trip():
    ids, counts = np.array([0, 3, 700, 8000]), np.array([1, 300, 70_000, 1 << 40])
    dense = divergence.unpack(divergence.pack(ids, counts), 8192)
    assert np.flatnonzero(dense).tolist() == ids.tolist()
    assert dense[ids].tolist() == counts.tolist()
    assert not divergence.unpack(None, 5).any()


def byte_vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def odd_texts():
    rng = random.Random(2)
    letters = [*"abcdefgh XYZ\n  '!_09", "é", "漢", "🎉", "́", "²", "½", "\x1c", "\x85", " ", "ՙ", "\U00010940", "꟎"]
    mixed = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 400))) for _ in range(60)]
    return [*mixed, "", "<|endoftext|>", "a<|endoftext|><|endoftext|> b<|endoftext", "aaaa" * 2001, "ab" * 999 + "ba" * 1000, "'s't're I'll 'LL we've", " \n\n  a  ", "x" * 50000]


def test_bpe_equals_the_library():
    from tokenizers import Tokenizer

    whole, own, texts = Tokenizer.from_file(byte_vocabulary()), bpe.ByteCoder(byte_vocabulary()), odd_texts()
    for _ in range(2):
        for text, ids in zip(texts, own.encode(texts), strict=True):
            expected = whole.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<i4").tolist() == expected
            assert own.decode(np.array(expected, np.int64)).decode("utf-8", "replace") == whole.decode(expected, skip_special_tokens=False)


def test_bpe_of_long_texts_and_a_small_memory(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "PIECE", 500)
    monkeypatch.setattr(bpe, "CACHE", 40)
    monkeypatch.setattr(bpe, "SYMBOLS", 64)
    whole, own = Tokenizer.from_file(byte_vocabulary()), bpe.ByteCoder(byte_vocabulary())
    texts = ["  ".join(odd_texts()), "<|endoftext|> some more " * 400]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<i4").tolist() == whole.encode(text, add_special_tokens=False).ids
        assert own.decode(np.frombuffer(ids, "<i4")).decode() == text


def test_bpe_decodes_any_ids():
    from tokenizers import Tokenizer

    whole, own = Tokenizer.from_file(byte_vocabulary()), bpe.ByteCoder(byte_vocabulary())
    ids = [RNG.randrange(50257) for _ in range(3000)]
    assert own.decode(np.array(ids)).decode("utf-8", "replace") == whole.decode(ids, skip_special_tokens=False)


def test_bpe_digests(spark):
    from tokenizers import Tokenizer

    whole, digest = Tokenizer.from_file(byte_vocabulary()), lambda x: hashlib.sha256(x.encode()).hexdigest()
    docs = frame(spark, ODD)
    expected = Counter()
    for i, _, _, text in ODD:
        ids = whole.encode(text or "", add_special_tokens=False).ids
        expected[i, len(ids), digest(",".join(map(str, ids))), digest(whole.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(tuple(r) for r in bpe.digests(bpe.round_trip(docs, byte_vocabulary())).collect()) == expected
    assert Counter(tuple(r) for r in bpe.digests(bpe.decode(bpe.encode(docs, byte_vocabulary()), byte_vocabulary())).collect()) == expected
    assert bpe.round_trip(frame(spark, []), byte_vocabulary()).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["text"] for r in bpe.decode(nothing, byte_vocabulary()).collect()] == ["", ""]


def words_of(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))


def test_rows_of_one_id_are_cut_by_their_own_text(spark):
    """A passage that a smaller id has goes from the row that holds it alone: not from rows of the same id with other, shorter, empty or null texts."""
    from cytolake.llm.substring_dedup import cut_repeats

    passage, own, short = words_of(80, 1), words_of(200, 2), "short text"
    rows = [(1, passage), (2, passage + " tail"), (2, None), (2, ""), (2, short), (2, own), (2, passage + " tail"), (3, words_of(30, 4) + " " + passage + " " + words_of(30, 5)), (3, own + " more"), (None, passage), (None, None)]
    docs = spark.createDataFrame([(i, t, -1, "x", "y", 5) for i, t in rows], "doc_id long, text string, n_chars int, doc string, spans string, tag int")
    got = Counter((r["doc_id"], r["text"]) for r in cut_repeats(docs.repartition(4)).collect())
    cut = [(1, passage), (2, "tail"), (2, None), (2, ""), (2, short), (2, own), (2, "tail"), (3, words_of(30, 4) + " " + words_of(30, 5)), (3, "more"), (None, passage), (None, None)]
    assert Counter((i, " ".join(t.split()) if t else t) for i, t in got.elements()) == Counter(cut)
    assert cut_repeats(docs.limit(0)).count() == 0


def test_chunk_tables_have_small_row_groups(spark, tmp_path):
    """A task that writes or reads chunks holds a few of them; by default all that a task wrote was one row group."""
    import glob

    import pyarrow.parquet as pq

    from cytolake.llm import common, language_model

    docs = spark.range(8000).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 300), i -> md5(cast(id * 1000 + i as string)))) as text", "true as trained").coalesce(1)
    table = common.materialise(language_model.chunks(docs), "chunk-groups", common.LARGE_ROWS)
    files = [pq.ParquetFile(f).metadata for p in table.inputFiles() for f in glob.glob(p.replace("file://", ""))]
    groups = [m.row_group(i).total_byte_size for m in files for i in range(m.num_row_groups)]
    assert sum(groups) > 70 << 20 and max(groups) < 50 << 20
    assert table.selectExpr("sum(size(text))").first()[0] == 8000
