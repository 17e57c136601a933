"""Document operators against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import compare
from tidemark.llm import decontamination, language, lookup_sketch, near_duplicates, substrings
from tidemark.llm import words as W
from tidemark.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, n_words long, row string"


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", None, None, "x", 1, "r") for i, t in rows], SCHEMA)


def wordy(seed, n, vocabulary=400):
    chance = random.Random(seed)
    return [f"w{chance.randrange(vocabulary)}" for _ in range(n)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, QUERIES[name], ORACLES[name], SF_DIR) is None


# Repeated passages


def kept_by_hand(rows, window=13):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    owner = {}
    for i, w in words:
        for at in range(len(w) - window + 1):
            run = tuple(w[at : at + window])
            if i is not None:
                owner[run] = min(owner.get(run, i), i)
    out = []
    for i, w in words:
        gone = set()
        for at in range(len(w) - window + 1):
            if i is not None and owner[tuple(w[at : at + window])] < i:
                gone.update(range(at, at + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def passages():
    common, other = " ".join(wordy(1, 40)), " ".join(wordy(2, 13))
    rows = [(9, common), (3, f"a b\x0bc {common}\n\td"), (4, None), (5, ""), (6, "  \n"), (7, f"{other} {common[:-1]}")]
    rows += [(8, other), (8, other), (2, f"Ä {other} é日本"), (None, common), (None, None), (11, " ".join(wordy(3, 30_000)))]
    rows += [(12, "x " * 40), (13, "x " * 14), (14, "x " * 12), (15, f"{other}\xa0{other}"), (8, common)]
    return rows


@pytest.mark.parametrize("crowded", [4000, 0])
def test_repeated_passages(spark, crowded, monkeypatch):
    monkeypatch.setattr(substrings, "CROWDED", crowded)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 50)
    found = substrings.remove_repeated(frame(spark, passages())).collect()
    got = [(r["row"]["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found]
    assert sorted(got, key=str) == sorted(kept_by_hand(passages()), key=str)


def test_workers_hold_small_arrays():
    """Of a batch of texts, what lives beside it in a worker is bounded, for passages and for languages."""
    texts = pa.array([" ".join(wordy(k, 300)) for k in range(3000)])
    language._kept.clear()
    tracemalloc.start()
    try:
        for _, data, offsets in W.groups(texts):
            substrings._anchored(W.words_of(data, offsets, W.AS_IS, W.NOT_BLANK), 13, 5)
        _, passages = tracemalloc.get_traced_memory()
        tracemalloc.reset_peak()
        for _, data, offsets in W.groups(texts, language.GROUP_BYTES):
            codes, owner = language.letters_of(data, offsets)
            for size in language.SIZES:
                language.grams_of(codes, owner, size)
        _, languages = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert passages < 40e6 and languages < 40e6, (passages, languages)


def test_repeated_passages_of_nothing(spark):
    assert substrings.remove_repeated(frame(spark, [])).count() == 0


def test_a_very_common_line(spark):
    line = " ".join(wordy(5, 8))
    rows = [(i, " ".join(wordy(100 + i, 20) + [line] + wordy(300 + i % 7, 20))) for i in range(60)]
    found = substrings.remove_repeated(frame(spark, rows)).collect()
    got = [(r["row"]["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found]
    assert sorted(got) == sorted(kept_by_hand(rows))


@pytest.mark.parametrize("seed", range(20))
def test_automaton_owners(seed):
    chance = random.Random(seed)
    texts = [[chance.choice("abc") for _ in range(chance.randint(1, 14))] for _ in range(12)]
    automaton = substrings.SuffixAutomaton()
    for owner, text in enumerate(texts):
        automaton.add(text, owner)
    automaton.close()
    for text in [*texts, list("abcabcxab")]:
        for window in (1, 3, 5):
            want = []
            for at in range(len(text) - window + 1):
                run = text[at : at + window]
                having = [o for o, t in enumerate(texts) if any(t[k : k + window] == run for k in range(len(t)))]
                want.append(min(having) if having else None)
            assert automaton.owners(text, window) == want


# Near duplicates


def groups_by_hand(rows, percent, size):
    sets = []
    for _, t in rows:
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if find(m) == find(k) and rows[m][0] is not None]
        least = min(ids, default=None)
        out.append((i, len(sets[k]), least, i == least))
    return out


def copies():
    chance = random.Random(3)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "one"), (7, "Ä ä"), (None, "one two"), (4, "other text here now")]
    at = 100
    for seed in range(6):
        base = wordy(seed, 120)
        for _ in range(14):
            text = list(base)
            for _ in range(chance.choice([0, 1, 2, 3, 4, 6])):
                text[chance.randrange(len(text))] = f"new{chance.random()}"
            rows.append((at, " ".join(text)))
            at += chance.choice([1, 3])
    rows.append((99, "z " * 40_000))
    rows += rows[20:24]
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize(("similarity", "size"), [(0.85, 3), (0.8, 5)])
def test_near_duplicates(spark, similarity, size):
    found = near_duplicates.components(frame(spark, copies()), similarity, size).collect()
    got = [(r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found]
    assert sorted(got, key=str) == sorted(groups_by_hand(copies(), round(100 * similarity), size), key=str)


def family(seed):
    """Copies of two related texts with more and less changed, near the threshold on either side."""
    chance = random.Random(seed)
    one = wordy(seed, 120, 5000)
    two = one[:90] + wordy(seed + 1, 40, 5000)
    rows = []
    for k in range(150):
        text = list(chance.choice((one, one, two)))
        for _ in range(chance.choice((0, 1, 2, 3, 4, 5, 6, 8))):
            at = chance.randrange(len(text))
            text[at : at + chance.randrange(2)] = wordy(chance.random(), chance.randrange(3), 5000)
        # Some share what they have more.
        rows.append((k, " ".join(text + (["shared", "tail", "of", "some", "words"] if k % 7 == 0 else []))))
    return rows


@pytest.mark.parametrize("similarity, size, hubs", [(0.85, 3, 1), (0.85, 3, 3), (0.8, 5, 1)])
def test_near_duplicates_in_families(spark, similarity, size, hubs, monkeypatch):
    monkeypatch.setattr(near_duplicates, "HUBS", hubs)
    rows = family(hubs)
    found = near_duplicates.components(frame(spark, rows), similarity, size).collect()
    got = [(r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found]
    want = groups_by_hand(rows, round(100 * similarity), size)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len({w[2] for w in want}) > 5


def around_a_short_text():
    """Texts that hold a short one and a common passage, each among words of its own; some have near copies."""
    chance = random.Random(5)
    short, passage = wordy(1, 60, 5000), wordy(2, 8, 5000)
    rows = [(0, " ".join(short))]
    for k in range(1, 161):
        tail = [f"own{k}x{n}" for n in range(60)]
        at = chance.randrange(60)
        text = short + tail[:at] + passage + tail[at:]
        rows.append((k, " ".join(text)))
        if k % 8 == 0:
            text[chance.randrange(len(text))] = "other"
            rows.append((1000 + k, " ".join(text)))
    return rows


def test_far_members_of_a_family_make_no_pairs(spark, monkeypatch):
    made, plain = {}, near_duplicates.stored

    def counted(frame, label):
        made[label] = plain(frame, label)
        return made[label]

    monkeypatch.setattr(near_duplicates, "stored", counted)
    # Nothing is found by hubs, so that all links are left to the join by differences.
    monkeypatch.setattr(near_duplicates, "_hub_pairs", lambda members, *_: members.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0))
    rows = around_a_short_text()
    found = near_duplicates.components(frame(spark, rows), 0.8, 5).collect()
    got = [(r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found]
    assert sorted(got, key=str) == sorted(groups_by_hand(rows, 80, 5), key=str)
    assert sum(not r["kept"] for r in found) == 20
    # The last pairs stored are those to be verified: the 20 links and few others.
    assert 20 <= made["pairs"].count() <= 60


def test_bands_for_any_similarity():
    for similarity in (0.3, 0.5, 0.7, 0.8, 0.85, 0.9, 0.99, 1.0):
        bands, rows = near_duplicates.banding(similarity)
        assert bands * rows <= near_duplicates.WIDTH
        assert (1 - similarity**rows) ** bands <= near_duplicates.MISSED


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates.components(frame(spark, [])).count() == 0


def test_sketches_agree_as_the_sets_do():
    import numpy as np

    hashes = near_duplicates.W.mixed(np.arange(1, 1201).astype(np.uint64))
    for n, common in ((1200, 1000), (40, 30), (3, 2)):
        shift = n - common
        a, b = hashes[: n - shift // 2], hashes[shift - shift // 2 : n]
        both = np.concatenate([a, b])
        text = np.repeat([0, 1], [len(a), len(b)])
        s = near_duplicates.sketches(both, text, 2, 2000)
        assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
        overlap = len(set(a.tolist()) & set(b.tolist())) / len(set(both.tolist()))
        assert abs((s[0] == s[1]).mean() - overlap) < 0.06


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in near_duplicates.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}


# Contamination


@pytest.mark.parametrize("part_words", [1_000_000, 40])
def test_contamination(spark, part_words):
    item = wordy(8, 30)
    items = [(1, " ".join(item)), (2, "Short Item!"), (3, None), (4, "--"), (10, " ".join(item[3:18])), (None, "no id here"), (1, "short-item")]
    items.append((5, "the the the the the the the the the the the the the"))
    docs = [(1, " ".join(item).upper()), (2, " ".join(item[:12])), (3, None), (4, ""), (5, "a short item b"), (6, "shor titem short\xa0item")]
    docs += [(7, " ".join(item[2:15] + wordy(9, 5000) + item[10:25])), (8, "short"), (9, "the " * 14), (None, "no, id. here"), (5, "a short item b")]
    docs += [(11, " ".join(item) + " ".join(item)), (12, "x" * 50_000), (13, "no id hereé")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contamination(frame(spark, docs), benchmark, part_words=part_words).collect()
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = []
    for i, t in items:
        w = word.findall((t or "").translate(lower))
        runs += [(i, w[k : k + 13]) for k in range(max(len(w) - 12, 1)) if w]
    want = []
    for i, t in docs:
        w = word.findall((t or "").translate(lower))
        hit, ids = set(), set()
        for item_id, run in runs:
            for k in range(len(w) - len(run) + 1):
                if w[k : k + len(run)] == run:
                    hit.update(range(k, k + len(run)))
                    ids.add(str(item_id))
        ids.discard("None")
        want.append((i, len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w), sorted(hit)))
    got = [
        (r["row"]["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"], [k for s in r["spans"] for k in range(s["first"], s["end"])])
        for r in found
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    nothing = decontamination.contamination(frame(spark, docs), benchmark.limit(0))
    assert nothing.where("n_hit > 0 OR contaminated").count() == 0 and nothing.count() == len(docs)
    assert decontamination.contamination(frame(spark, []), benchmark).count() == 0


# Language


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op1_language"](spark, "/root/testdata/sf0.01").join(docs, "doc_id")
    right = found.where("held_out").agg(F.avg(F.expr("double(lang = lang_pred)")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.98 and right[1] >= 0 and right[2] <= 1
    assert found.count() == docs.count()


def test_language_of_odd_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    filters = language.fit(docs)
    long = " ".join(r["text"] for r in docs.where("lang = 'fr'").collect()) * 20
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, long), (None, "Les éou"), (5, "x"), (5, "x"), (6, "日本 İ")]
    got = [(r["row"]["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(frame(spark, rows), filters).collect()]
    assert len(got) == len(rows)
    assert [g[1:] for g in sorted(got, key=str) if g[0] in (1, 2, 3)] == [("und", 0.0)] * 3
    assert next(g for g in got if g[0] == 4)[1] == "fr"
    assert all(0 <= g[2] <= 1 for g in got)
    none = language.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language.identify(frame(spark, rows), none).collect()} == {"und"}


def test_filter_masks_name_every_holder():
    import numpy as np

    grams = {f"l{k}": near_duplicates.W.mixed(np.arange(k * 500, k * 500 + 1000).astype(np.uint64)) for k in range(11)}
    filters = language.Filters.build(grams, positions=1 << 14)
    for bit, name in enumerate(filters.languages):
        held = filters.masks(grams[name])
        assert ((held[:, bit // 8] >> bit % 8) & 1).all()
    other = near_duplicates.W.mixed(np.arange(10**6, 10**6 + 20_000).astype(np.uint64))
    n, hits = filters.hits(other, np.zeros(len(other), int), 1)
    assert n[0] == len(other) and np.allclose(hits[0] / n[0], filters.false_rate, atol=0.01)


def test_held_out_labels_change_nothing(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held = F.col("doc_id").cast("string").cast("binary")
    changed = docs.withColumn("lang", F.when(F.crc32(held) % 4 == 2, "xx").otherwise(F.col("lang")))
    changed.withColumn("source", F.lit("other")).write.parquet(str(tmp_path / "documents.parquet"))
    plain, other = (
        sorted(QUERIES["op1_language"](spark, where).collect()) for where in (SF_DIR, str(tmp_path))
    )
    assert plain == other
    assert {r["held_out"] for r in plain} == {True, False} and "xx" not in {r["lang_pred"] for r in plain}


def test_corrected_counts_are_near_those_of_plain_sets():
    import numpy as np

    chance = np.random.default_rng(3)
    grams = {f"l{k}": near_duplicates.W.mixed(np.arange(k * 3000, k * 3000 + 4000).astype(np.uint64)) for k in range(5)}
    filters = language.Filters.build(grams, positions=1 << 16)
    pool = near_duplicates.W.mixed(np.arange(0, 40_000).astype(np.uint64))
    texts = [chance.choice(pool[k * 3000 : k * 3000 + 8000], 2000) for k in range(5)]
    hashes, owner = np.concatenate(texts), np.repeat(np.arange(5), 2000)
    n, counts = filters.hits(hashes, owner, 5)
    for k, text in enumerate(texts):
        exact = np.array([np.isin(text, grams[name]).mean() for name in filters.languages])
        corrected = (counts[k] / n[k] - filters.false_rate) / (1 - filters.false_rate)
        assert np.allclose(corrected, exact, atol=0.02)
        assert language.decide(filters, n, counts)[0][k] == exact.argmax()


# Lookup sketches


def test_lookup_sketches(spark):
    chance = random.Random(2)
    lines = ["\n".join(" ".join(wordy(chance.random(), 6)) for _ in range(n)) for n in (1, 2, 3, 5, 8, 13, 40, 400)]
    texts = ["", None, "a", "日本é\nb. c", lines[3], lines[3], *lines, "s. " * 5000, "q" * 9000]
    rows = [(3 * k - 9, t) for k, t in enumerate(texts)]
    found = {r["doc_id"]: r for r in lookup_sketch.compare_versions(frame(spark, rows)).collect()}
    parts = lambda t: {p for p in re.split(r"\n+|(?<=[.!?])[ \t]+", t) if p}
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = found[i]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for column, other in (("near_edited", edited), ("near_next", after)):
            a, b = parts(t), parts(other)
            assert r[column] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    assert found[3]["fingerprint"] == found[6]["fingerprint"] != found[9]["fingerprint"]


def test_lookup_sketches_of_texts_without_sentences(spark):
    chance = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    makers = {
        "words": lambda: " ".join(wordy(chance.random(), 2000)),
        "marked": lambda: " ".join(w + chance.choice([".&&&", "%%%", "!#"]) for w in wordy(chance.random(), 2000)),
        "letters": lambda: "".join(chance.choices(letters, k=8000)),
        "han": lambda: "".join(chr(0x4E00 + chance.randrange(3000)) for _ in range(8000)),
        "signs": lambda: "".join(chr(0x1F300 + chance.randrange(200)) for _ in range(8000)),
        "sentences": lambda: "".join(f"{chr(0x4E00 + chance.randrange(3000))}{k}。" for k in chance.sample(range(9999), 30)),
    }
    texts = [make() for make in makers.values() for _ in range(2)]
    # The second text of each pair is the first behind some words, so half of the paragraphs are edited away.
    for k in range(0, len(texts), 2):
        texts[k + 1] = " ".join(wordy(k, 20)) + (" " if k < 4 else "\n") + texts[k]
    found = {r["doc_id"]: r for r in lookup_sketch.compare_versions(frame(spark, list(enumerate(texts)))).collect()}
    for k in range(0, len(texts), 2):
        assert 0.4 < found[k]["near_edited"] < 0.55
        assert found[k]["near_next"] > 0.8


def test_lookup_sketches_of_repeated_words(spark):
    texts = ["so " * 3000, "a b c " * 900, "abc" * 3000, "一二三" * 3000, "x\ty  z" * 500, "end"]
    found = {r["doc_id"]: r for r in lookup_sketch.compare_versions(frame(spark, list(enumerate(texts)))).collect()}
    assert all(found[k]["near_edited"] > 0 for k in range(5))


def test_parts_are_the_paragraph(spark):
    chance = random.Random(8)
    texts = ["".join(chance.choices(["w", "xy", " ", "\t", "  ", "é", "日", "😀", "q" * 70, "ab" * 50], k=300)) for _ in range(40)]
    rows = spark.createDataFrame([(t,) for t in texts], "p string").selectExpr("p", f"{lookup_sketch._cut('p')} AS parts").collect()
    assert all("".join(r["parts"]) == r["p"] for r in rows)


def test_lookup_sketches_of_repeated_and_missing_ids(spark):
    rows = [(1, "a b\nc d"), (1, "a b\nc d"), (None, "x"), (2, "e")]
    found = lookup_sketch.compare_versions(frame(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "1", "2", "None"]
    assert lookup_sketch.compare_versions(frame(spark, [])).count() == 0


def test_lookup_sketches_make_the_digests_of_a_text_once(spark, monkeypatch):
    made, real = [], lookup_sketch.digests
    monkeypatch.setattr(lookup_sketch, "digests", lambda text: made.append(text) or real(text))
    rows = [(1, "a b\nc d"), (1, "x\ny"), (None, "a b\nc d"), (2, "x\ny"), (2, "e\nf"), (3, "x\ny")]
    found = lookup_sketch.compare_versions(frame(spark, rows)).collect()
    assert sorted(made) == ["''", "edited", "text"]
    # Each row has the digests of its own text, also where another text stands for its id.
    prints = {r["fingerprint"] for r in found if r["n_chars"] == 7}
    assert len(found) == 6 and len(prints) == 1
    assert len({r["fingerprint"] for r in found}) == 3


# Pipeline


def test_pipeline_on_planted_documents(spark, tmp_path):
    real = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").limit(60).collect()
    clean = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in real]
    long = max((r for r in clean), key=lambda r: len(r[1]))
    passage = " ".join(f"shared{k}" for k in range(60))
    item = " ".join(f"question{k}" for k in range(20))
    planted = [
        (1000, long[1], "en", None, None),
        (1001, None, "en", "s", 0),
        (1002, "12 34", None, "s", 5),
        (1003, f"{clean[0][1]} {passage}", "en", "s", 1),
        (1004, f"{clean[1][1]} {passage}", "en", "s", 1),
        (1005, item, "en", "s", 1),
    ]
    types = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(clean + planted, types).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        seen[name] = {r["doc_id"]: r.asDict() for r in docs.collect()}
    assert not {1001, 1002} & set(seen["language"])
    by_hand = groups_by_hand([(i, r["text"]) for i, r in seen["language"].items()], 80, 5)
    assert set(seen["near_duplicates"]) == {i for i, _, _, kept in by_hand if kept}
    assert 1000 not in seen["near_duplicates"]
    near = [(i, r["text"]) for i, r in seen["near_duplicates"].items()]
    for i, _, n_removed, kept in kept_by_hand(near):
        row = seen["repeated_passages"][i]
        assert row["text"] == (kept if n_removed else dict(near)[i])
        assert not n_removed or row["n_chars"] == len(kept)
    assert "shared3" not in seen["repeated_passages"].get(1004, {"text": ""})["text"]
    assert set(seen["repeated_passages"]) - set(seen["contamination"]) == {1005}
    assert set(seen["packing"]) == set(seen["contamination"])


def test_pipeline_of_nothing(spark, tmp_path):
    types = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], types).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
