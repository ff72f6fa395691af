"""Operators on documents against brute force, and on awkward rows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import DOC, words
from weftgraph.llm import decontaminate, langid, near_copies, pieces, shuffle_shards, simhash, suffix_spans


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


# ---- 2 SentencePiece


def test_pieces_equal_the_library(make_docs, awkward):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    texts = awkward + ["  two  spaces ", "tab\tand\nline", "ends with space ", " starts", "Ünïcode wörds", "1.5 + 2,3%%% ***"]
    found = by_id(pieces.encode_decode(make_docs(texts, extra=True), pieces.model_path()), "piece_ids", "piece_text")
    for i, t in enumerate(texts):
        ids = sp.encode(t or "")
        assert list(found[i][0]) == ids
        assert found[i][1] == sp.decode(ids)


def test_piece_digests(make_docs, awkward):
    found = by_id(pieces.token_digests(make_docs(awkward), pieces.model_path()), "n_tokens", "ids_sha256", "decoded_sha256")
    codec = pieces.Codec(pieces.model_path(), check=False)
    for i, (ids, text) in enumerate(codec.encode_batch([t or "" for t in awkward])):
        assert found[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_piece_decoding_of_broken_bytes():
    codec = pieces.Codec(pieces.model_path(), check=False)
    rng = np.random.default_rng(5)
    for _ in range(300):
        ids = rng.integers(3, 600, 12).tolist()
        assert codec.decode(ids) == codec.library.decode(ids)


def test_piece_agendas_agree():
    codec = pieces.Codec(pieces.model_path(), check=False)
    run = "▁" + "".join(words(3, 30).split())
    assert codec.merge(run) == codec._merge_short(list(run))


def test_words_in_step_equal_single_agendas():
    codec = pieces.Codec(pieces.model_path(), check=False)
    texts = {w for k in range(40) for w in words(k, 400, "etaoinshrdlu,.-'Ää1").split()} | {"a", "x" * 40, "x" * 41, "aaaaaaaa", "日本", "é😀", "...", "\t", "a\nb"}
    found = codec.learn_words(sorted(texts))
    assert found.keys() == texts
    for w, raw in found.items():
        ids = codec.library.encode(w)
        assert np.frombuffer(raw, "<i4").tolist() == ids
        assert [codec.ids.get(p) for p in codec.merge("▁" + w)] == [i if i not in codec.byte_of else None for i in ids] or any(i in codec.byte_of for i in ids)


def test_clashing_piece_columns(make_docs):
    rows = make_docs(["one two", None]).selectExpr("*", "1 AS piece_ids", "2 AS piece_text")
    found = pieces.encode_decode(rows, pieces.model_path())
    assert found.columns.count("piece_ids") == 1 and {r["doc_id"]: r["piece_text"] for r in found.collect()} == {0: "one two", 1: ""}


def test_pieces_empty(empty):
    assert pieces.encode_decode(empty, pieces.model_path()).count() == 0


# ---- 3 decontamination


def brute_overlap(text, items):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    own = pattern.findall(low)
    hit, found = set(), set()
    for item, t in items:
        if item is None or t is None:
            continue
        w = pattern.findall(t.lower())
        for i in range(max(1, len(w) - 7)) if w else ():
            window = w[i : i + 8]
            for j in range(len(own) - len(window) + 1):
                if own[j : j + len(window)] == window:
                    hit.update(range(j, j + len(window)))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("bits", [decontaminate.FILTER_BITS, (4, 4)])
def test_overlaps(spark, make_docs, awkward, monkeypatch, bits):
    monkeypatch.setattr(decontaminate, "FILTER_BITS", bits)
    items = [(1, words(10, 20)), (2, words(11, 5)), (3, ""), (4, None), (None, words(12, 9)), (5, words(13, 8)), (5, words(14, 12)), (30, "word")]
    texts = awkward + [words(20, 10) + " " + items[0][1].upper() + " " + words(21, 3), items[1][1] + "; " + items[5][1], " ".join(items[0][1].split()[3:12]), items[1][1] * 3]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = decontaminate.find_overlaps(make_docs(texts, extra=True), bench)
    for row in df.collect():
        n, hit, ids = brute_overlap(texts[row["doc_id"]], items)
        assert (row["n_words"], sum(s["last"] - s["first"] for s in row["hit_spans"]), list(row["item_ids"])) == (n, hit, ids)


def test_overlaps_at_word_places(spark, make_docs):
    item = words(15, 11).split()
    long = words(16, 40_000).split()
    texts = [" ".join(item[k : k + n]) for k in range(4) for n in (7, 8, 9)] + [" ".join(long[:k] + item[:8] + long[k:]) for k in (0, 1, 20_000, 40_000)] + [" ".join(item + item)]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item[2:10])), (3, item[0] + " " + item[1])], "item_id long, text string")
    for row in decontaminate.find_overlaps(make_docs(texts), bench).collect():
        n, hit, ids = brute_overlap(texts[row["doc_id"]], [tuple(r) for r in bench.collect()])
        assert (row["n_words"], sum(s["last"] - s["first"] for s in row["hit_spans"]), list(row["item_ids"])) == (n, hit, ids)


def test_clashing_overlap_columns(spark, make_docs):
    bench = spark.createDataFrame([(1, "a b c d e f g h i")], "item_id long, text string")
    rows = make_docs(["a b c d e f g h", "x"]).selectExpr("*", "1 AS n_words", "2 AS hit_spans", "3 AS item_ids", "4 AS file", "5 AS `at`", "6 AS `a.b`", "7 AS token")
    found = decontaminate.find_overlaps(rows, bench)
    assert found.columns == [c for c in rows.columns if c not in ("n_words", "hit_spans", "item_ids")] + ["n_words", "hit_spans", "item_ids"]
    assert {(r["doc_id"], r["n_words"], r["file"], r["at"], r["a.b"], r["token"]) for r in found.collect()} == {(0, 8, 4, 5, 6, 7), (1, 1, 4, 5, 6, 7)}
    left = decontaminate.without_overlaps(rows, bench)
    assert left.columns == rows.columns and [r["doc_id"] for r in left.collect()] == [1]


def test_overlaps_empty(spark, empty, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_overlaps(empty, none).count() == 0
    assert decontaminate.find_overlaps(make_docs(["a b"]), none).first()["n_words"] == 2


# ---- 6 suffix array


def brute_repeats(texts, least):
    raw = [(t or "").encode() for t in texts]
    met = Counter(b[i : i + least] for b in raw for i in range(len(b) - least + 1))
    out = []
    for b in raw:
        cut = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - least + 1):
            if met[b[i : i + least]] > 1:
                cut[i : i + least] = True
        out.append((int(cut.sum()), int((np.diff(np.r_[0, cut.astype(int)]) == 1).sum()), np.frombuffer(b, np.uint8)[~cut].tobytes() if b else b""))
    return out


@pytest.mark.parametrize("most", [suffix_spans.MOST_CONTENTS, 1])
def test_repeated_bytes(make_docs, awkward, most):
    shared = words(30, 60)
    texts = awkward + [words(31, 40) + shared + words(32, 40), shared[:250] + words(33, 30), words(34, 20) + shared[10:], "ab" * 400, shared + " x " + shared, "é" * 150]
    texts[7] = texts[8] = words(2, 600)
    expected = brute_repeats(texts, 200)
    for row in suffix_spans.remove_repeats(make_docs(texts, extra=True), most_contents=most).collect():
        removed, spans, kept = expected[row["doc_id"]]
        assert (sum(s["last"] - s["first"] for s in row["removed_spans"]), len(row["removed_spans"]), bytes(row["kept"])) == (removed, spans, kept)


def test_repeats_keep_clashing_columns(make_docs):
    rows = make_docs([words(30, 80), words(30, 80), None]).selectExpr("*", "1 AS print", "2 AS spans", "3 AS removed_spans", "4 AS kept", "5 AS `a.b`")
    found = suffix_spans.remove_repeats(rows)
    assert found.columns == [c for c in rows.columns if c not in ("removed_spans", "kept")] + ["removed_spans", "kept"]
    assert {(r["doc_id"], r["print"], r["spans"], r["a.b"], len(r["removed_spans"])) for r in found.collect()} == {(0, 1, 2, 5, 1), (1, 1, 2, 5, 1), (2, 1, 2, 5, 0)}


def test_boundaries_by_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        least = int(rng.choice([8, 13, 20]))
        parts = ["".join(rng.choice(list("ab"), rng.integers(1, 60))).encode() for _ in range(rng.integers(1, 8))]
        weights = rng.integers(1, 3, len(parts)).tolist()
        met = Counter()
        for p, w in zip(parts, weights):
            for i in range(len(p) - least + 1):
                met[p[i : i + least]] += w
        for p, again in zip(parts, suffix_spans.repeated_starts(parts, weights, least)):
            assert list(again) == [met[p[i : i + least]] >= 2 for i in range(len(p) - least + 1)]


def test_segments_meet_equal_strings():
    """Every string of the length lies in the segment of an anchor that its content alone decides."""
    shared = words(40, 80).encode()
    a, b = b"zz " + shared + b" q", words(41, 30).encode() + shared
    at = {}
    for k, text in enumerate((a, b)):
        anchor, _, first, last, _ = suffix_spans.segments(text)
        assert first[0] == 0 and last[-1] == len(text) - 200 and (first[1:] == last[:-1] + 1).all()
        for h, f, l in zip(anchor, first, last):
            for s in range(f, l + 1):
                at.setdefault(text[s : s + 200], set()).add(int(h))
    assert all(len(v) == 1 for v in at.values())


def test_repeats_empty(empty):
    assert suffix_spans.remove_repeats(empty).count() == 0


# ---- 7 SimHash


def brute_groups(texts, shingle=3, most=2):
    prints = []
    for t in texts:
        w = (t or "").encode().lower().split()
        n = len(w)
        parts = [b" ".join(w)] if 0 < n <= shingle else [b" ".join(w[i : i + shingle]) for i in range(n - shingle + 1)]
        h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0)
    label = list(range(len(texts)))
    for _ in texts:
        for i in range(len(texts)):
            for j in range(len(texts)):
                if (prints[i] ^ prints[j]).bit_count() <= most:
                    label[i] = min(label[i], label[j])
    return [(f"{p:016x}", c) for p, c in zip(prints, label)]


@pytest.mark.parametrize("hot", [16_384, 2])
def test_simhash_groups(spark, make_docs, awkward, hot):
    long = words(50, 400).split()
    texts = [t if t is None or len(t) < 6000 else words(2, 300) for t in awkward] + [" ".join(long[:k] + ["changed"] + long[k + 1 :]) for k in range(0, 400, 23)]
    prints = simhash.add_fingerprints(make_docs(texts, extra=True), keep_text=False)
    distinct = prints.groupBy("_fp").agg({"doc_id": "min"}).select("_fp")
    links = simhash.spanning_links(distinct, simhash.RING, hot_key=hot)
    expected = brute_groups(texts)
    groups = simhash.near_duplicate_groups(prints, simhash.RING)
    found = by_id(prints.join(groups, "_fp").selectExpr("doc_id", "lower(hex(_fp)) AS f", "component_id"), "f", "component_id")
    assert [found[i] for i in range(len(texts))] == expected
    for a, b in links.collect():
        assert bytes(a) != bytes(b)


def test_fingerprints_of_long_texts(make_docs):
    texts = [words(2, 30_000), "a b " * 40_000, None, " \t\n", "one", "one two", "A B c"]
    found = by_id(simhash.add_fingerprints(make_docs(texts).selectExpr("*", "1 AS _fp")).selectExpr("doc_id", "lower(hex(_fp)) AS f"), "f")
    for i, t in enumerate(texts):
        w = (t or "").encode().lower().split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))] if w else []
        value = sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert found[i][0] == f"{value:016x}"


def test_ring_finds_all_pairs_within_the_distance():
    rng = np.random.default_rng(2)
    ring = simhash.RING
    for _ in range(400):
        x = int(rng.integers(0, 2**63))
        y = x
        for b in rng.choice(64, rng.integers(0, 3), replace=False):
            y ^= 1 << int(b)
        pair = np.array([[x], [y]], dtype=np.uint64)
        keys = ring.keys(pair)
        shared = [s for s in range(ring.segments) if keys[0, s] == keys[1, s]]
        assert any(len(ring.linked(pair[:1], pair[1:], np.array([s]))) for s in shared)


def test_keep_one_of_each(spark, make_docs, awkward):
    base = words(60, 500).split()
    near = [" ".join(base[:k] + ["x"] + base[k + 1 :]) for k in (0, 100, 250)]
    texts = awkward + near + [words(61, 200)]
    rows = make_docs(texts).unionByName(make_docs(texts).limit(3)).unionByName(spark.createDataFrame([(None, near[0], "en", "s", 1), (None, words(62, 90), None, None, None)], DOC))
    kept = near_copies.keep_one_of_each(rows)
    assert kept.columns == rows.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(" ".join((t or "").lower().split()), i)
    expected = {i for t, i in groups.items()} - {6, len(awkward) + 1, len(awkward) + 2}
    assert {i for none, i in ids if not none} == expected
    assert sum(none for none, _ in ids) == 1


def overlapping(seed, common, own):
    """Two texts whose sets of 5-word shingles share ``common`` and have ``own`` more each."""
    shared = words(seed, common + 4)
    return [shared + " " + words(seed + k, own) for k in (100_000, 200_000)]


def stay(make_docs, texts):
    return {r["doc_id"] for r in near_copies.keep_one_of_each(make_docs(texts)).collect()}


def test_repeated_lines_do_not_make_near_duplicates(make_docs):
    texts = []
    for k in range(20):
        line = words(1000 + k, 10)
        texts += [" ".join([line] * 30) + " " + words(seed + k, 200) for seed in (2000, 3000)]
    assert stay(make_docs, texts) == set(range(40))


def test_pairs_below_the_similarity_stay(make_docs):
    pairs = [overlapping(4000 + k, common, 20) for k, common in enumerate([159, 150, 120, 100, 80] * 12)]
    assert stay(make_docs, [t for p in pairs for t in p]) == set(range(120))


def test_pairs_at_the_similarity_are_found(make_docs):
    pairs = [overlapping(5000 + k, common, 20) for k, common in enumerate([160, 170, 190, 210, 226] * 40)]
    assert stay(make_docs, [t for p in pairs for t in p]) == set(range(0, 400, 2))


@pytest.mark.parametrize("most", [4096, 3, 1])
def test_stage_groups_by_brute_force(make_docs, awkward, monkeypatch, most):
    monkeypatch.setattr(near_copies, "BLOCK_TEXTS", most)
    base = words(63, 150).split()
    texts = list(awkward) + [" ".join(base[:k] + ["x"] * (k % 4) + base[k + k % 5 :]) for k in range(0, 150, 4)] + ["a b c d e f g h i", "a b c d e f g h", "a b c d"]
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a == b or 5 * len(a & b) >= 4 * len(a | b):
                    label[i] = min(label[i], label[j])
    assert stay(make_docs, texts) == set(label)


def test_one_group_of_near_copies_in_many_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK_TEXTS", 8)
    base = words(80, 120).split()
    near = [" ".join(base[:k] + [f"x{j}"] + base[k + 1 :]) for j in range(2) for k in range(0, 120, 3)]
    # Strays share most of the text, but not enough of it with any near copy; the last two are near to one another only.
    far = [" ".join(base[:90] + words(90 + j, 30).split()) for j in range(12)]
    pair = [" ".join(base[:88] + words(200, 32).split() + [w]) for w in ("a", "b")]
    assert stay(make_docs, near + far + pair) == {0} | set(range(len(near), len(near) + 13))


def test_stage_keeps_clashing_columns(spark, make_docs, tmp_path):
    texts = [words(70, 50), words(70, 50), words(71, 50), None, ""]
    rows = make_docs(texts).selectExpr("*", "1 AS file", "2 AS `at`", "3 AS _metadata", "4 AS keys", "5 AS node", "6 AS `a.b`")
    kept = near_copies.keep_one_of_each(rows)
    assert kept.columns == rows.columns
    assert sorted(tuple(r)[0] for r in kept.collect()) == [0, 2, 3]
    assert {tuple(r)[5:] for r in kept.collect()} == {(1, 2, 3, 4, 5, 6)}
    rows.write.parquet(str(tmp_path / "read"))
    assert sorted(tuple(r)[0] for r in near_copies.keep_one_of_each(spark.read.parquet(str(tmp_path / "read"))).collect()) == [0, 2, 3]


def test_wide_ring_requires_chains_that_every_near_pair_has():
    rng = np.random.default_rng(3)
    ring = near_copies.RING
    left = rng.integers(0, 2**63, (2000, 6), dtype=np.uint64)
    flips = np.array([np.isin(np.arange(384), rng.choice(384, n, replace=False)) for n in rng.integers(0, 200, 2000)])
    right = left ^ np.packbits(flips, axis=1).view(">u8").astype(np.uint64)
    apart = flips.sum(axis=1)
    assert set(ring.linked(left, right, np.zeros(2000, dtype=np.int64))) == set(np.flatnonzero(apart <= ring.differing))
    chained = ring.chained(np.bitwise_count(ring.parts(left ^ right)).astype(np.int16))
    assert chained[apart <= ring.differing].all() and chained[apart > 180].mean() < 0.2


def test_simhash_empty(empty):
    assert near_copies.keep_one_of_each(empty).count() == 0


# ---- 8 language


def test_languages(spark, make_docs, awkward):
    kinds = {"en": "etaoin", "de": "äöüschn", "xx": "кирлцы"}
    texts, langs = list(awkward), [None] * len(awkward)
    for k, (lang, letters) in enumerate(kinds.items()):
        for i in range(60):
            texts.append(words(1000 * k + i, 20, letters))
            langs.append(lang)
    texts += ["123 ...", "日本"]
    langs += ["en", None]
    docs = make_docs(texts, extra=True, langs=langs)
    model = langid.train_on_documents(docs)
    assert model.languages == ["de", "en", "xx"]
    found = by_id(langid.identify(docs.drop("lang"), model), "lang_pred", "lang_score")
    held = by_id(docs.select("doc_id", langid.held_out().alias("h")), "h")
    import zlib

    assert all(held[i][0] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in held)
    for i, (t, lang) in enumerate(zip(texts, langs)):
        if not any(c.isalpha() for c in t or ""):
            assert found[i] == ("und", 0.0)
        elif lang:
            assert found[i][0] == lang and 0 <= found[i][1] <= 1
        else:
            assert found[i][0] in kinds


def brute_ngrams(text, dimensions):
    codes, out = [ord(c) for c in text.lower()], Counter()
    for i in range(len(codes)):
        hashed = 0
        for n in (1, 2, 3):
            if i + n <= len(codes):
                hashed = (hashed * 0x01000193 + codes[i + n - 1]) % 2**32
                out[((hashed ^ n) * 0x9E3779B1 % 2**32 >> 8) & (dimensions - 1)] += 1
    return out


@pytest.mark.parametrize("block", [1 << 20, 97])
def test_ngrams_by_brute_force(monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    texts = ["", "a", words(70, 500), "Zwölf ß", words(71, 3), "", "x" * 97, "y" * 98]
    found = [Counter() for _ in texts]
    for rows, columns in langid.ngram_entries(texts, (1, 2, 3), 256):
        assert (np.diff(rows) >= 0).all()
        for r, c in zip(rows.tolist(), columns.tolist()):
            found[r][c] += 1
    assert found == [brute_ngrams(t, 256) for t in texts]


@pytest.mark.parametrize("block", [1 << 20, 97])
def test_language_scores_by_brute_force(monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    rng = np.random.default_rng(6)
    log_prob = np.log(rng.dirichlet(np.ones(256), 3)).astype(np.float32)
    model = langid.Model(["aa", "bb", "cc"], np.log([0.5, 0.25, 0.25]), log_prob, (1, 2, 3))
    texts = [None, "", "123", "one", words(70, 500), "é", words(72, 40), "一"]
    names, scores = langid.score_texts(texts, model)
    for t, name, score in zip(texts, names, scores):
        if not any(c.isalpha() for c in t or ""):
            assert (name, score) == ("und", 0.0)
            continue
        total = [p + sum(n * float(log_prob[k, c]) for c, n in brute_ngrams(t, 256).items()) for k, p in enumerate(model.log_prior)]
        best = int(np.argmax(total))
        assert name == model.languages[best] and score == pytest.approx(1 / sum(np.exp(x - total[best]) for x in total), rel=1e-6)


def test_languages_that_tie():
    model = langid.Model(["aa", "bb"], np.log([0.5, 0.5]), np.zeros((2, 256), dtype=np.float32), (1, 2, 3))
    assert langid.score_texts(["word"], model)[0] == ["aa"]


def test_clashing_language_columns(make_docs):
    rows = make_docs(["some words", None]).selectExpr("*", "1 AS lang_pred", "2 AS lang_score", "3 AS `a.b`")
    found = langid.identify(rows, langid.train_on_documents(rows))
    assert found.columns == [c for c in rows.columns if not c.startswith("lang_")] + ["lang_pred", "lang_score"] and found.count() == 2


def test_languages_empty(empty):
    model = langid.train_on_documents(empty)
    assert langid.identify(empty, model).count() == 0 and langid.score_texts(["abc"], model)[0] == ["und"]


# ---- 10 sharding


@pytest.mark.parametrize("bucket", [1 << 20, 2000])
def test_shards(spark, make_docs, awkward, bucket):
    texts = awkward + [words(i, 20) for i in range(90)]
    rows = make_docs(texts, extra=True)
    rows = rows.unionByName(rows.limit(5)).unionByName(rows.limit(2))
    found = shuffle_shards.external_shuffle(rows, bucket_bytes=bucket).collect()
    assert len(found) == len(texts) + 7
    by_shard = Counter(r["shard"] for r in found)
    assert max(by_shard.values()) - min(by_shard[s] for s in range(16)) <= 1
    for s in by_shard:
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(by_shard[s]))
    for r in found:
        assert r["_size"] == len((texts[r["doc_id"]] or "").encode()) + 1
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in shuffle_shards.external_shuffle(rows.repartition(3), bucket_bytes=bucket).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in found}


def test_shards_of_repeats_that_fill_buckets(spark, make_docs):
    rows = make_docs([words(5, 100)]).crossJoin(spark.range(400)).drop("id").unionByName(spark.createDataFrame([(None, words(6, 100), "en", "s", 1)] * 200, DOC))
    table = shuffle_shards.external_shuffle(rows, bucket_bytes=20_000)
    found = table.collect()
    assert max(Counter(r["_bucket"] for r in found).values()) < 200
    by_shard = Counter(r["shard"] for r in found)
    assert sum(by_shard.values()) == 600 and max(by_shard.values()) - min(by_shard.values()) <= 1
    for s in by_shard:
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(by_shard[s]))


def test_op10_by_its_contract(spark, make_docs, awkward, tmp_path):
    import zlib

    texts = awkward + [words(i, 20) for i in range(50)]
    make_docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    found = shuffle_shards.op10_shuffle_shards(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(len(texts)))
    for r in found:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    assert {(r["shard"], r["slot"]) for r in found} == {(p % 16, p // 16) for p in range(len(texts))}


def test_fisher_yates():
    assert sorted(shuffle_shards.fisher_yates(1000, 1, 2)) == list(range(1000))
    first = Counter(int(shuffle_shards.fisher_yates(4, 1, b)[0]) for b in range(4000))
    assert min(first.values()) > 850
    assert len(shuffle_shards.fisher_yates(0, 1, 1)) == 0


def test_shards_empty(empty):
    assert shuffle_shards.external_shuffle(empty).count() == 0


def test_repeats_leave_only_their_spans_on_disk(spark):
    from weftgraph.llm.suffix_spans import remove_repeats
    from weftgraph.plans import lineage

    shared, before = "abcdefghij" * 30, set(lineage._written)
    docs = spark.createDataFrame([(1, "one " + shared), (2, "two " + shared), (3, "short")], "doc_id long, text string")
    found = remove_repeats(docs)
    assert [p.rsplit("/", 1)[1].split("-")[1] for p in lineage._written if p not in before] == ["spans"]
    assert {r["doc_id"]: len(r["removed_spans"]) for r in found.collect()} == {1: 1, 2: 1, 3: 0}
