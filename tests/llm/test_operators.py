"""Operators against brute force, exact round trips or held-out accuracy, on small tables."""

import math
import random
import re
import zlib
from collections import Counter
from itertools import pairwise

import numpy as np
import pytest

from cytolake.llm import decontamination, language_model, licenses, near_dedup, packing, quality, shards, substring_dedup, tokens, toxicity, url_filter
from cytolake.llm.queries import BLOCKED_NAMES, URL_RULES, vocabulary

RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choice(["ba", "ke", "li", "mo", "nu", "ra", "si", "to"]) for _ in range(RNG.randint(2, 4))) for _ in range(700)]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def changed(text, every, seed=1):
    words = text.split()
    for i in range(7, len(words), every):
        words[i] = f"changed{seed}x{i}"
    return " ".join(words)


#: Rows that every operator must take: nulls, empty and odd texts, repeats, and columns with clashing names.
ODD = [(None, "row without an id"), (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "é😀 \x1c x\x00y <|endoftext|>"), (6, "same row"), (6, "same row"), (7, "word " * 3000), (8, prose(4000, 3)), (9, "x" * 50000)]


def frame(spark, rows, clash=True):
    if clash:
        return spark.createDataFrame([(i, t, 1, "a", 2, 3, "n") for i, t in rows], "doc_id long, text string, start int, bucket string, row int, length int, node string")
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_tokens_equal_the_library():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary())
    texts = [t or "" for _, t in ODD] + ["ΑΣ ΑΣ. Σ", "DON'T it's we'll", "日本語 テスト 123 ١٢", "ﬁ K Å \u0301a", "a\x85b\u2003c", "İI ŒÆ ßẞ"] + [prose(200, 9).title()]
    for ids, expected in zip(tokens.WordEncoder(vocabulary()).encode(texts), whole.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == expected.ids


def test_first_fit_equals_brute_force():
    rng = random.Random(1)
    lengths = sorted((rng.randint(1, 64) for _ in range(400)), reverse=True)
    free, expected = [], []
    for n in lengths:
        at = next((i for i, f in enumerate(free) if f >= n), len(free))
        if at == len(free):
            free.append(64)
        expected.append((at, 64 - free[at]))
        free[at] -= n
    assert list(zip(*packing.first_fit(lengths, 64), strict=True)) == expected


def test_packing_covers_every_id(spark):
    rows = packing.pack_documents(frame(spark, ODD), vocabulary(), size=256, with_ids=True).toPandas()
    encode = tokens.WordEncoder(vocabulary()).encode
    expected = Counter((i if i is not None else -1, encode([t or ""])[0] + (1).to_bytes(4, "little")) for i, t in ODD)
    found = Counter()
    for key, doc in rows.fillna({"doc_id": -1}).groupby("doc_id"):
        doc = doc.sort_values("start")
        copies = (doc["start"] == 0).sum()
        found[(int(key), b"".join(doc["ids"].iloc[::copies]))] += copies
    assert found == expected
    assert (rows["ids"].map(zlib.crc32) == rows["ids_crc32"]).all()
    for _, sequence in rows.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert sequence["offset"].tolist() == [0, *sequence["length"].cumsum().tolist()[:-1]] and sequence["length"].sum() <= 256


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 4097])
def test_permutation_is_one(n):
    assert sorted(shards.permute(np.arange(n), n, 77).tolist()) == list(range(n))


def test_shards_round_trip(spark, tmp_path):
    docs = frame(spark, ODD).repartition(3)
    path = f"file://{tmp_path}/out"
    table = shards.materialise(shards.cut_sequences(docs, vocabulary(), 128), "sequences")
    rows = shards.write_shards(table, path, 9, size=128, records_per_shard=10).toPandas().sort_values("slot")
    assert rows["slot"].tolist() == list(range(len(rows)))
    records = list(shards.read_records(path, 0, 10**6, 128, 10))
    assert [zlib.crc32(r.tobytes()) for r in records] == rows["ids_crc32"].tolist()
    again = list(shards.read_records(path, 13, 4, 128, 10))
    assert all((a == b).all() for a, b in zip(again, records[13:17], strict=True))
    encoded = [np.append(np.frombuffer(e, "<u4"), 1) for e in tokens.WordEncoder(vocabulary()).encode([t or "" for _, t in ODD])]
    assert rows["n_tokens"].sum() == sum(map(len, encoded))
    # the ids of all records with the same first document and those behind it are the documents' own, one after another
    for r, record in zip(rows.itertuples(), records, strict=True):
        ids = record[: r.n_tokens].tolist()
        own = [e for (i, _), e in zip(ODD, encoded, strict=True) if i == r.doc_id or (i is None and r.doc_id != r.doc_id)]
        assert any(e[r.start : r.start + len(ids)].tolist() == ids[: len(e) - r.start] for e in own)
        assert set(record[r.n_tokens :].tolist()) <= {49407}
    assert Counter(i for r, record in zip(rows.itertuples(), records, strict=True) for i in record[: r.n_tokens].tolist()) == Counter(i for e in encoded for i in e.tolist())


def test_shards_are_written_at_once(spark, tmp_path):
    docs = frame(spark, ODD).repartition(3)
    path = f"file://{tmp_path}/out"
    rows = shards.materialise_order(docs, vocabulary(), path, 5, 64, 4)
    assert rows.count() == len(list(shards.read_records(path, 0, 10**6, 64, 4))) > 8
    assert shards.materialise_order(docs.limit(0), vocabulary(), f"{path}-none").count() == 0
    again = shards.materialise_order(docs, vocabulary(), f"{path}-2", 5, 64, 4)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_toxicity_held_out(spark):
    bad = ["vile", "filthy", "rotten", "stupid", "nasty"]
    rows, labels = [], []
    for i in range(400):
        words = prose(60, i).split()
        if toxic := i % 4 == 0:
            for k in range(0, 60, 12):
                words[k] = bad[(i + k) % 5]
        if toxic and i % 8 == 0:
            words += ["###"] * 3 + ["awful"] * 4
        rows.append((i, " ".join(words)))
        if i < 300:
            labels.append((i, 0 if i % 8 == 0 else 1, int(toxic)))
    docs, table = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in toxicity.judge(docs, table).collect()}
    held = range(300, 400)
    assert sum(found[i]["toxic"] == (i % 4 == 0) for i in held) >= 97
    assert np.mean([found[i]["severity"] for i in held if i % 8 == 0]) > np.mean([found[i]["severity"] for i in held if i % 8 == 4]) > 0.5
    odd = toxicity.judge(frame(spark, ODD), table.limit(0)).collect()
    assert len(odd) == len(ODD) and not any(r["toxic"] for r in odd)


def edit_distance_within(item, text):
    """Least edits of the item over all places of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        before, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (a != b))
    return min(row)


def test_decontamination_equals_brute_force(spark):
    items = [(k, prose(20, 100 + k)) for k in range(5)]
    rng, rows = random.Random(3), []
    for i in range(30):
        text = list(items[i % 5][1])
        for _ in range(i % 10):
            at = rng.randrange(len(text))
            text[at : at + rng.randint(0, 1)] = rng.choice(["z", "", "q"])
        rows.append((i, prose(50, i) + " " + "".join(text).upper() + ". " + prose(30, 900 + i) if i % 3 else prose(80, i)))
    bench = spark.createDataFrame([*items, (9, None), (10, "short")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontamination.find_leaks(frame(spark, rows), bench).collect()}
    expected = {}
    for i, t in rows:
        for k, item in items:
            item, text = decontamination.plain(item), decontamination.plain(t)
            if (e := edit_distance_within(item, text)) <= decontamination.edits(len(item)):
                expected[(i, k)] = e
    assert found == expected and 0 < len(found) < 30
    assert decontamination.find_leaks(frame(spark, ODD), bench).count() == 0
    assert decontamination.find_leaks(frame(spark, rows), bench.limit(0)).count() == 0
    blocks = decontamination.find_leaks(frame(spark, rows), bench, max_letters=50)
    assert {(r["doc_id"], r["item_id"]): r["edits"] for r in blocks.collect()} == expected


@pytest.mark.parametrize("length", [*range(2, 22), 34, 50])
def test_short_items_are_found_within_their_budget(length):
    rng = random.Random(length)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    item = letters(length)
    items, found, expected = decontamination.Items([(1, item), (2, letters(40))]), [], []
    for k in range(60):
        own = list(item)
        for _ in range(k % 4):
            at = rng.randrange(len(own) + 1)
            own[at : at + rng.randint(0, 1)] = rng.choice(["z", ""])
        text = letters(30) + "".join(own) + letters(30)
        least = edit_distance_within(item, text)
        expected.append(least if least <= decontamination.edits(length) else None)
        found.append(min((h[1] for h in decontamination.find_items(items, text) if h[0] == 0), default=None))
    assert found == expected and any(x is not None for x in found)


def test_licenses_equal_brute_force(spark):
    near = licenses.TEMPLATES["ISC"][0].replace("any purpose", "every purpose")
    wrapped = licenses.TEMPLATES["MIT"][0].replace(", ", ",\n")
    rows = [(1, "Released under the MIT License."), (2, f"{prose(30, 1)}\n{near}\n{prose(9, 2)}"), (3, f"intro\n\n{wrapped}\nend of it all"), (4, prose(300, 4)), (5, "licensed under the")]
    found = {(r["doc_id"], r["license"]): r for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    assert set(found) == {(1, "MIT line"), (2, "ISC"), (3, "MIT")}
    a, b = (Counter(pairwise(licenses.plain(x).split())) for x in (near, licenses.TEMPLATES["ISC"][0]))
    assert math.isclose(found[(2, "ISC")]["dice"], 2 * (a & b).total() / (a.total() + b.total()))
    assert (found[(2, "ISC")]["first_line"], found[(2, "ISC")]["last_line"]) == (1, 1)
    assert licenses.scan_licenses(frame(spark, ODD)).count() == 0


def test_licenses_within_lines_and_one_behind_the_other(spark):
    whole = lambda name: texts if isinstance(texts := licenses.TEMPLATES[name], str) else texts[-1]
    lines = lambda t: "\n".join(re.findall(r".{1,70}(?:\s|$)", t))
    both = f"{lines(whole('MIT'))}\n\n{lines(whole('Apache-2.0'))}"
    rows = [(1, f"{prose(20, 1)}: released under the MIT License. {prose(20, 2)}"), (2, both), (3, f"{whole('ISC')} {whole('ISC')}"), *[(10 + k, f"Copyright (c) 2020 {prose(3, k)}\n{lines(whole(n))}\n{prose(200, k)}") for k, n in enumerate(["MIT", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-or-later", "MPL-2.0", "Apache-2.0"])]]
    found = sorted((r["doc_id"], r["first_line"], r["license"]) for r in licenses.scan_licenses(frame(spark, rows)).collect())
    expected = [(1, "MIT line"), (2, "MIT"), (2, "Apache-2.0"), (3, "ISC"), (3, "ISC"), (10, "MIT"), (11, "BSD-2-Clause"), (12, "BSD-3-Clause"), (13, "GPL-2.0-or-later"), (14, "GPL-3.0-or-later"), (15, "LGPL-2.1-or-later"), (16, "MPL-2.0"), (17, "Apache-2.0")]
    assert [(i, n) for i, _, n in found] == expected


def test_licenses_equal_all_stretches():
    """Wherever some stretch of words is near a template, one that meets it is found, and its Dice is right."""
    rng, texts = random.Random(6), {f"t{k}": prose(12 + 4 * k, 70 + k) for k in range(4)}
    templates = licenses.Templates(texts, 0.8)
    bags = {n: Counter(pairwise(t.split())) for n, t in texts.items()}
    for k in range(60):
        words = prose(10, 400 + k).split()
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(list(texts.values())).split()
            for _ in range(rng.randint(0, 3)):
                part[rng.randrange(len(part))] = rng.choice(VOCABULARY)
            words += part[rng.randint(0, 3) :] + prose(rng.randint(0, 6), 500 + k).split()
        raw = np.frombuffer(" ".join(words).encode(), np.uint8)
        near = {}
        for name, bag in bags.items():
            for i in range(len(words) - 1):
                for j in range(i + 1, len(words)):
                    own = Counter(pairwise(words[i : j + 1]))
                    if (share := 2 * (own & bag).total() / (own.total() + bag.total())) >= 0.8:
                        near[(name, i, j)] = share
        found = licenses.scan_block(raw, np.array([0, len(raw)]), templates)
        assert bool(found) == bool(near)
        assert all(any(n == name and math.isclose(share, dice) and j - i == size for (n, i, j), share in near.items()) for _, _, _, name, dice, size in found)
        starts, ends, _ = licenses.find_words(raw, np.array([0, len(raw)]))
        pairs = licenses.pair_hashes(licenses.hash_words(raw, starts, ends))
        place, template = templates.hits(pairs)
        for t, name in enumerate(templates.names):
            own = np.sort(place[template == t])
            spans = [(lo, hi) for lo, hi, _ in licenses.passages(own.tolist(), pairs[own].tolist(), templates.bags[t], int(templates.sizes[t]), 0.8)]
            assert all(any(lo < j and i <= hi for lo, hi in spans) for n, i, j in near if n == name)


def test_language_model_base_and_score(spark):
    rows = [(i, prose(80, i % 120) if i % 120 < 40 else prose(80, i)) for i in range(300)] + [r for r in ODD if r[0] is None or r[0] not in range(300)] + [(1000, None), (1001, "")]
    found = language_model.score_corpus(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    split = lambda t: [w.translate({65 + k: 97 + k for k in range(26)}) for w in re.findall("[^\x20\x09-\x0d]+", t or "")] + [None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not held(i) for w in split(t))
    n, v = counts.total(), len(counts)
    texts = dict(rows)
    for r in found:
        words = split(texts[r["doc_id"]])
        assert r["held_out"] == held(r["doc_id"]) and r["train_tokens"] == n and r["n_tokens"] == len(words)
        assert r["n_known"] == sum(counts[w] > 0 for w in words)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
    out = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    own = frame(spark, rows).select("doc_id", "text")
    model, table = language_model.train(own)
    whole = {(r["doc_id"], r["n_tokens"]): r["base_score"] for r in language_model.score(own, model, table).collect()}
    parts = {(r["doc_id"], r["n_tokens"]): r["base_score"] for r in language_model.score(own, model, table, max_words=100).collect()}
    assert whole.keys() == parts.keys() and all(math.isclose(whole[k], parts[k], rel_tol=1e-9) for k in whole)


def test_language_model_filter_grows(spark):
    """A segment has its bits for each n-gram and level however many there are, and scores follow exact levels."""
    keys = language_model.mix(np.arange(5_000_000, dtype=np.uint64))
    words = language_model.segment(keys, np.ones(len(keys), np.int64), 10)
    model = language_model.Filter(1, words, np.array([0]), np.array([len(words)]), 1, 1)
    assert (model.levels(language_model.mix(np.arange(10**8, 10**8 + 20000, dtype=np.uint64))) > 0).mean() < 0.05
    rows = [(i, prose(80, i % 90)) for i in range(200)] + [(300, None), (None, prose(30, 5))]
    split = lambda t: [*(t or "").split(), None]
    trained = [split(t) for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    one, two = Counter(w for t in trained for w in t), Counter(p for t in trained for p in pairwise([None, *t]))
    about = lambda c: float(language_model.ESTIMATE[language_model.level_of(np.array([c]))[0]]) if c else 0.0
    size, texts = sum(map(about, one.values())) + len(one) + 1, dict(rows)
    for r in language_model.score_corpus(frame(spark, rows).repartition(3), bits_per_key=60).collect():
        expected = 0.0
        for v, w in pairwise([None, *split(texts[r["doc_id"]])]):
            a, b = about(one[v]), about(one[w])
            expected += math.log10((min(about(two[v, w]), a, b) + 10 * (b + 1) / size) / (a + 10))
        assert math.isclose(r["score"], expected, rel_tol=2e-2, abs_tol=1e-9)


def test_language_model_chances_add_up(spark):
    """Of words alone to 1; behind a word to about 1, as far as levels allow."""
    rows = [(i, prose(60, i % 50)) for i in range(150)]
    model, _ = language_model.train(frame(spark, rows).select("doc_id", "text"), bits_per_key=60)
    words = sorted({w for _, t in rows for w in t.split()})
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = language_model.find_words(raw, np.array([0, len(raw)]))
    keys = np.append(language_model.hash_words(raw, starts, ends), language_model.END)
    about = language_model.ESTIMATE[model.levels(keys)]
    chance = (about + 1) / (model.mass + model.types + 1)
    assert math.isclose(chance.sum() + 1 / (model.mass + model.types + 1), 1, rel_tol=2e-2)
    for k in range(0, len(keys), 29):
        pair = np.minimum(language_model.ESTIMATE[model.levels(language_model.mix(keys[k] * np.uint64(0xD6E8FEB86659FD93) + keys + np.uint64(1)))], np.minimum(about[k], about))
        assert 0.6 < ((pair + 10 * chance) / (about[k] + 10)).sum() < 1.5


def test_filter_has_no_false_negatives():
    keys = language_model.mix(np.arange(5000, dtype=np.uint64))
    words = np.zeros(2000, np.uint64)
    for level in (1, 2):
        np.bitwise_or.at(words, *language_model.probe_places(keys, level, 2000))
    model = language_model.Filter(1, words, np.array([0]), np.array([2000]), 1, 1)
    assert (model.levels(keys) >= 2).all() and (model.levels(language_model.mix(np.arange(9000, 14000, dtype=np.uint64))) == 0).mean() > 0.8


def passages_by_brute_force(rows, size=50):
    seen, out = {}, set()
    for i, t in sorted(rows):
        words = (t or "").lower().split()
        for k in range(len(words) - size + 1):
            first = seen.setdefault(tuple(words[k : k + size]), i)
            if first != i:
                out |= {(i, w) for w in range(k, k + size)}
    return out


def test_substring_dedup_covers_exact_repeats(spark):
    shared = [prose(60, 500 + k) for k in range(4)]
    rows = [(i, " ".join([prose(70, i), shared[i % 4] if i % 3 else "", prose(40, 700 + i)])) for i in range(1, 60)] + [(100, prose(400, 8)), (101, prose(400, 8)), (102, changed(prose(400, 8), 60)), (103, prose(400, 77)), (104, "loop it " * 300), (105, "loop it " * 200)]
    found = substring_dedup.repeated_passages(frame(spark, rows)).collect()
    covered = {(r["doc_id"], w) for r in found for w in range(r["start_word"], r["end_word"])}
    assert passages_by_brute_force(rows) <= covered
    assert all(r["kept_doc_id"] < r["doc_id"] for r in found) and 103 not in {r["doc_id"] for r in found}
    near = {w for i, w in covered if i == 102}
    assert len(near) > 350  # an edit every 60 words
    assert substring_dedup.repeated_passages(frame(spark, [(1, prose(100, 1)), (2, prose(100, 2)), *[r for r in ODD if r[0] not in (1, 2)]])).count() == 0
    assert substring_dedup.repeated_passages(frame(spark, []).limit(0)).count() == 0


def test_substring_dedup_covers_what_a_later_partner_shares(spark):
    rows = []
    for k, (short, long) in enumerate([(60, 65), (60, 70), (60, 80), (60, 90), (200, 210)] * 6):
        words = prose(long, 2000 + k).split()
        rows += [(100 * k + j, f"{prose(80, 9000 + 10 * k + j)} {' '.join(words[:n])} {prose(80, 9500 + 10 * k + j)}") for j, n in enumerate((short, long, long), 1)]
    found = substring_dedup.repeated_passages(frame(spark, rows)).collect()
    covered = {(r["doc_id"], w) for r in found for w in range(r["start_word"], r["end_word"])}
    assert passages_by_brute_force(rows) <= covered


def test_substring_dedup_links_one_passage_in_many_documents(spark):
    shared = prose(60, 77)
    rows = [(i, f"{prose(30 + i % 7, 5000 + i)} {shared} {prose(30, 9000 + i)}") for i in range(2000)]
    found = {r["doc_id"]: r for r in substring_dedup.repeated_passages(frame(spark, rows)).collect()}
    assert len(found) == 1999 and all(r["kept_doc_id"] == 0 for r in found.values())
    assert all(0 <= 30 + i % 7 - r["start_word"] <= 3 and 0 <= r["end_word"] - 90 - i % 7 <= 3 for i, r in found.items())  # words next to it agree by chance


@pytest.mark.parametrize("edit", ["change", "insert", "delete"])
def test_substring_dedup_recall_of_near_passages(spark, edit):
    """At least nine in ten passages of 55 words with one word edited are found, and no other document."""
    rng, rows = random.Random(4), []
    for k in range(200):
        words = prose(55, 3000 + k).split()
        other, at = list(words), rng.randrange(2, 53)
        other[at : at + (edit != "insert")] = [] if edit == "delete" else ["edited"]
        rows += [(3 * k + j, f"{prose(60, 20000 + 3 * k + j)} {' '.join(w)} {prose(60, 30000 + 3 * k + j)}") for j, w in enumerate((words, other, []))]
    found = {r["doc_id"] for r in substring_dedup.repeated_passages(frame(spark, rows)).collect()}
    assert len(found) >= 180 and all(i % 3 == 1 for i in found)


def test_cut_repeats(spark):
    shared = prose(80, 1)
    rows = [(1, f"first {shared} end"), (2, f"second\n{shared}\nlast"), (3, shared), (4, None), (5, ""), (6, "short text")]
    found = dict(substring_dedup.cut_repeats(frame(spark, rows, clash=False)).select("doc_id", "text").collect())
    assert found[1] == rows[0][1] and found[4] is None and found[5] == "" and found[6] == "short text" and 3 not in found
    assert found[2].split() == ["second", "last"]


def test_compact_windows_hold_their_least():
    rng = np.random.default_rng(1)
    data = " ".join(f"w{x}" for x in rng.integers(0, 500, 400)).encode()
    raw = np.frombuffer(data, np.uint8)
    records = substring_dedup.windows(raw, np.array([0, len(raw)]), np.array([1]))
    starts, ends, _ = substring_dedup.find_words(raw, np.array([0, len(raw)]))
    runs = substring_dedup.shingle(substring_dedup.hash_words(raw, starts, ends), 5)
    least = set()
    for k in range(substring_dedup.HASHES):
        value = substring_dedup.mix(runs ^ substring_dedup.mix(np.array([k + 1], np.uint64)))
        least |= {int(value[i : i + substring_dedup.RUN].min()) for i in range(len(value) - substring_dedup.RUN + 1)}
    assert least == set(records["key"].tolist())


def similarity(a, b):
    bags = []
    for t in (a, b):
        words = t.lower().split()
        bags.append(Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))))
    return (bags[0] & bags[1]).total() / (bags[0] | bags[1]).total()


def test_near_dedup_equals_brute_force(spark):
    rows = []
    for i in range(0, 120, 4):
        text = prose(150 + i, 40 + i)
        rows += [(i, text), (i + 1, changed(text, 90, 1)), (i + 2, changed(text, 120, 2)), (i + 3, text.upper() if i % 8 else prose(100, 3000 + i))]
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    label = {i: i for i, _ in rows}
    for a, s in rows:
        for b, t in rows:
            if a < b and similarity(s, t) >= 0.8:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    assert found == label
    odd = near_dedup.near_duplicates(frame(spark, ODD)).collect()
    assert len(odd) == len(ODD) and all(r["class_id"] == r["doc_id"] and r["kept"] for r in odd)
    assert near_dedup.near_duplicates(frame(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("part", [1000, 25])
def test_near_dedup_links_a_family_of_chains(spark, monkeypatch, part):
    monkeypatch.setattr(near_dedup, "PART", part)
    rng = random.Random(8)
    texts = [prose(200, 8).split()]
    for k in range(1, 240):
        words = list(rng.choice(texts))
        for x in range(4):
            words[rng.randrange(200)] = f"new{k}x{x}"
        texts.append(words)
    ids = random.Random(1).sample(range(240), 240)
    rows = [(i, " ".join(words)) for i, words in zip(ids, texts, strict=True)]
    shingles = [{tuple(w[k : k + 5]) for k in range(196)} for w in texts]
    label = {i: i for i in ids}
    for a in range(240):
        for b in range(a):
            both = len(shingles[a] & shingles[b])
            if 5 * both >= 4 * (392 - both) and label[ids[a]] != label[ids[b]]:
                old, new = max(label[ids[a]], label[ids[b]]), min(label[ids[a]], label[ids[b]])
                label = {k: new if v == old else v for k, v in label.items()}
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert found == label


def test_alignment_counts_order():
    a = np.arange(100, dtype=np.uint32)
    assert near_dedup.aligned(a, a, 0.8) and near_dedup.aligned(a, a[:90], 0.8)
    assert not near_dedup.aligned(a, a[::-1].copy(), 0.8) and not near_dedup.aligned(a, a[:60], 0.8)


def test_url_filter_equals_brute_force(spark):
    urls = ["http://www.a.com/en/x", "https://EXAMPLE.com/en/77?x", "http://b.net/de/1#t", "http://x.example.net/de/8", "http://xexample.net/de/8", "ftp://spam-farm.org", "http://m.spam-farm.example.org/es/?q", "no scheme", "", None, "x://h?/en/", "://Host/p://q", "http://com/en/"]
    pages = spark.createDataFrame([(k, u, "h", "r") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    listed_hosts = url_filter.hosts_named(pages, BLOCKED_NAMES)
    rows = url_filter.filter_urls(pages, URL_RULES, listed_hosts).collect()
    for r in rows:
        u = urls[r["page_id"]] or ""
        rest = u.partition("://")[2] if "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [(len(x), x, v) for v, x in URL_RULES if (host == x.split("/")[0] or host.endswith("." + x.split("/")[0])) and path.startswith("/" + x.partition("/")[2])]
        blocked = bool(set(host.split(".")) & set(BLOCKED_NAMES))
        expected = (max(fits)[1], max(fits)[2]) if fits else (None, "block" if blocked else "allow")
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, *expected), u
    assert len(rows) == len(urls)
    assert url_filter.filter_urls(pages.limit(0), URL_RULES, listed_hosts).count() == 0
    joined = url_filter.filter_urls(pages, URL_RULES, listed_hosts, max_bytes=0)
    assert {r["page_id"]: r["verdict"] for r in joined.collect()} == {r["page_id"]: r["verdict"] for r in rows}


def test_url_filter_with_a_list_of_no_pattern(spark):
    rng = random.Random(9)
    hosts = [f"h{rng.getrandbits(40):x}.example.org" for _ in range(3000)]
    chosen = set(rng.sample(hosts, 400))
    pages = spark.createDataFrame([(k, f"https://{h.upper()}/p?{k}", 1) for k, h in enumerate(hosts)], "page_id long, url string, listed int")
    blocklist = spark.createDataFrame([(h,) for h in [*chosen, *chosen, "not.in.the.corpus", None]], "host string")
    rows = url_filter.filter_urls(pages, URL_RULES, blocklist).collect()
    assert {r["page_id"] for r in rows if r["verdict"] == "block"} == {k for k, h in enumerate(hosts) if h in chosen}
    assert len(rows) == len(hosts) and all(r["listed"] == (hosts[r["page_id"]] in chosen) for r in rows)


def test_cascade_is_exact(spark):
    keys = spark.range(5000).selectExpr("cast(id as string) AS key", "id % 7 = 0 AS listed")
    levels = url_filter.build_cascade(keys, bits_per_key=3)
    assert len(levels) > 2
    assert keys.filter(url_filter.listed(levels, keys["key"]) != keys["listed"]).count() == 0


def test_quality_base_and_field(spark):
    good = [(i, "\n".join(f"{prose(9, 10 * i + k).capitalize()}." for k in range(6))) for i in range(60)]
    bad = [(100 + i, "\n".join(" | ".join(prose(9, 10 * i + k).split()) for k in range(6))) for i in range(60)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good[:40]] + [(i, 0) for i, _ in bad[:40]], "doc_id long, quality int")
    rows = good + bad + [(500, "a b c d e f a b c d e f x y z\n\n"), (501, "Line one is here.\nLine one is here.\n  \nLine one is here."), *[(900 + (i or 0), t) for i, t in ODD]]
    docs = frame(spark, rows)
    found = {(r["doc_id"], r["n_words"]): r for r in quality.judge_quality(docs, quality.train_field(docs.select("doc_id", "text"), labels)).collect()}
    for i, t in rows:
        t = t or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        r = found[(i, len(words))]
        windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        repeated = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
        seen, again = set(), 0
        for line in t.split("\n"):
            if re.search("[^\x20\x09-\x0d]", line):
                again += line in seen
                seen.add(line)
        assert (r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (sum(map(len, words)), len(re.findall("[#*$%&|<>]", t)), again, len(repeated)), i
        assert r["base_failed"] == (len(words) < 10 or 100 * len(repeated) > 20 * len(words))
    by_id = {r["doc_id"]: r for r in found.values()}
    assert all(by_id[i]["kept"] for i, _ in good[40:]) and not any(by_id[i]["kept"] for i, _ in bad[40:])


def test_viterbi_equals_brute_force():
    from itertools import product

    rng = np.random.default_rng(2)
    field = quality.LineField(rng.normal(size=quality.SIGNS + 1), rng.normal(size=(2, 2)))
    emissions = field.emissions().tolist()
    for _ in range(20):
        marks = rng.integers(0, 1 << quality.SIGNS, 7).tolist()
        score = lambda y: sum(emissions[m] for m, l in zip(marks, y, strict=True) if l) + sum(field.steps[a, b] for a, b in pairwise(y))  # noqa: B023, E731, E741
        assert math.isclose(score(field.decode(marks, emissions)), max(map(score, product((0, 1), repeat=7))))
