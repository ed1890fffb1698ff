"""Operators against brute force, exact round trips and held-out accuracy."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindle.llm import ann, jaccard, katz, langid, mixing, pii, sentencepiece, sharding, topk, toxicity
from spindle.llm.pieces import read_pieces
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").cache()


def _components(texts, words, percent):
    sets = {}
    for i, t in texts:
        w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
        sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i
    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[a + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                x, y = root(i), root(j)
                top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("words,percent,limit", [(4, 85, 4096), (5, 80, 4096), (4, 85, 3)])
def test_jaccard(spark, docs, words, percent, limit):
    base = " ".join(f"w{i}" for i in range(60))
    more = [(10_000 + k, base.replace(f"w{k} ", f"v{k} ")) for k in range(12)]
    more += [(20_000 + k, base + " " + " ".join(f"u{j}" for j in range(k))) for k in range(14)]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           jaccard.jaccard_components(table, words, percent / 100, region_limit=limit).collect()}
    assert got == _components([(r.doc_id, r.text) for r in table.collect()], words, percent)


def test_katz_counts_and_base_scores(spark):
    rows = [(i, t) for i, t in enumerate(["a b a c", "b a", "a b b", "c a b a", "d a b", "a a b c", "b c", "e", "a b c", "c c a"] * 3)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    words = ["a", "b", "c", "d", "e", "unseen"]
    held = next(i for i in range(100, 10_000) if zlib.crc32(str(i).encode()) % 10 == 0)
    ids = [i for i in range(held, 200_000) if zlib.crc32(str(i).encode()) % 10 == 0][:len(words)]
    probe = spark.createDataFrame(list(zip(ids, words)), "doc_id long, text string")
    got = {r.doc_id: r for r in katz.katz_scores(table.unionByName(probe)).collect()}
    empty = spark.createDataFrame([(ids[0], "")], "doc_id long, text string")
    first = {r.doc_id: r for r in katz.katz_scores(table.unionByName(empty)).collect()}[ids[0]]
    train = [t.split() for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    counts: dict = {}
    for t in train:
        for w in [*t, "<end>"]:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, w in zip(ids, words):
        base = sum(np.log10((counts.get(x, 0) + 0.1) / (n + 0.1 * (v + 1))) for x in (w, "<end>"))
        assert got[i].train_tokens == n and abs(got[i].base_score - base) < 1e-9
        assert got[i].n_known == 1 + (w in counts) and got[i].score < 0
    assert first.n_tokens == 1


def test_good_turing_holds_on_counts_with_copies():
    # numbers of kinds with counts 1..6 of the given tables; n5 is close to n4 (copies), so that raw Turing factors pass 1
    for low in ([215810, 61309, 26017, 14862, 13741, 7222], [16971, 3831, 1233, 563, 507, 210], [206040, 32099, 5057, 1892, 2568, 660]):
        r, n = np.arange(1, 7), np.array(low, float)
        spread = np.log(n / np.append(np.ones(5), 1.0))        # neighbours are one apart
        slope = np.polyfit(np.log(r), spread, 1)[0]
        tail = 6 ** (slope + 1)
        want = ((1 + 1 / r[:5]) ** (slope + 1) - tail) / (1 - tail)
        got = katz.discounts(low)
        assert np.allclose(got[1:], want) and (got[1:] > 0).all() and (got[1:] < 1).all() and (np.diff(got[1:]) > 0).all()
    far = katz.discounts([100, 30, 5, 2], at=[1, 2, 7, 40])
    assert (far[1:] > 0).all() and (far[1:] < 1).all() and not np.allclose(far[1:], katz.discounts([100, 30, 5, 2])[1:])
    assert katz.discounts([4])[1] == 0.5                       # no line: absolute discounting


def test_pieces_match_brute_force_and_round_trip(spark, docs):
    normal, byte = read_pieces()
    pieces, names = {p: (i, s) for i, p, s in normal}, {i: p for i, p, _ in normal}
    longest, lowest = max(map(len, pieces)), min(s for _, _, s in normal)
    encoded = sentencepiece.encode(docs).cache()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in encoded.limit(25).collect():
        whole = "▁" + texts[r.doc_id].replace(" ", "▁")
        want = sentencepiece._with_bytes(whole, sentencepiece.viterbi(whole, pieces, longest, lowest), names, byte)
        assert r.ids == want
    assert {r.doc_id: r.text for r in sentencepiece.decode(encoded).collect()} == texts


def test_threshold_search_and_posting_lists(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16))
    x[100:400] = x[100]                                    # a hot vector
    rows = [(int(i), [float(a) for a in v]) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = np.floor(64 * x)
    exact = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_inner_products(table).collect()}
    found = {}
    for r in ann.nearest_vectors(table).collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    hits = 0
    for q in range(0, 3000, 20):
        s = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(3000), -s)) if i != q][:20]
        assert [exact[q, k + 1] for k in range(20)] == [(i, int(s[i])) for i in order]
        near = np.round(x @ x[q], 9)
        hits += len({i for i in np.lexsort((np.arange(3000), -near)) if i != q and near[i] >= np.sort(near)[-21]} & set(found[q])) >= 18
    assert hits >= 0.9 * 150


def test_shards_follow_the_law(spark, docs):
    got = sharding.shard_documents(docs).collect()
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert all(r.grown_shard in (r.shard, 8) for r in got) and any(r.grown_shard == 8 for r in got)
    tree = {"a": {"x": {0: 1.0, 1: 1.0}, "y": {2: 2.0}}, "b": {"z": {3: 1.0}}}
    heavier = {"a": {"x": {0: 1.0, 1: 1.0}, "y": {2: 4.0}}, "b": {"z": {3: 1.0}}}
    rows = spark.range(20_000)
    both = sharding.descend(sharding.descend(rows, "id", tree, "s"), "id", heavier, "t").groupBy("s", "t").count().collect()
    share = {s: sum(r["count"] for r in both if r.s == s) / 20_000 for s in range(4)}
    assert abs(share[2] - 0.4) < 0.02 and abs(share[0] - 0.2) < 0.02
    assert all(r.s == r.t or r.t in (0, 1, 2) for r in both)     # rows move into subtree "a" only
    assert all(r.s == 3 or r.t == 2 or r.s == r.t for r in both)   # and within "a" into the heavier shard only


def test_rates_meet_targets(spark, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    targets = {"good-en": 0.6, "poor": 0.4}
    got = mixing.document_rates(docs, labels, targets)
    whole = got.agg(*[F.sum(F.col("tokens") * F.col("rate") * F.col(f"p_{d}")).alias(d) for d in targets], F.sum("tokens").alias("t")).first()
    for d, share in targets.items():
        assert abs(whole[d] / whole["t"] - mixing.TOTAL * share) < 1e-3
    assert got.filter("rate < 0 or copies < floor(rate) or copies > floor(rate) + 1").count() == 0


def test_surrogates(spark):
    rows = [(1, "Write to Ann.Lee@Mail.example.com or ann.lee@mail.example.com, card 4111 1111 1111 1111."),
            (2, "Mrs. Mary Smith met Mr Smith; call +1 (988) 555-2485 from 42.144.35.254."), (3, "Иван Петров, password=b7db7aa4a5fcc78305"),
            (4, "nothing here 12 of 30"), (5, None)]
    out = {r.doc_id: r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[4].text == rows[3][1] and out[5].text is None and out[4].n_entities == 0
    for secret in ["ann.lee", "4111 1111", "Smith", "Mary", "555-2485", "42.144", "Петров", "b7db7aa4"]:
        assert all(secret.lower() not in (r.text or "").lower() for r in out.values())
    mails = [w.strip(",.") for w in out[1].text.split() if "@" in w]
    assert mails[0] == mails[1] and mails[0].endswith(".com")
    digits = out[1].text.split("card ")[1].strip(".").replace(" ", "")
    assert len(digits) == 16 and pii._luhn(digits) == 0
    assert out[2].text.split()[2] == out[2].text.split()[5].strip(";")         # one surname, one surrogate
    assert pii.find_entities("Dr. Jean Dupont")[0][2] == "name_m"


def test_surrogates_stay_distinct(spark, monkeypatch):
    real = pii.surrogate

    def narrow(kind, form, key, draw=0):                       # most first draws collide
        return real(kind, form, key, draw) if draw else "000-00-000" + str(len(form) % 2)
    monkeypatch.setattr(pii, "surrogate", narrow)
    rows = [(i, f"number {100 + i}-{10 + i}-{1000 + i} end") for i in range(30)]
    table = pii.surrogate_table(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(table) == 30 == len({r.new for r in table}) and any(r.draw for r in table)


def test_toxicity_and_language_on_held_out_rows(spark):
    folder = SMALL.replace("sf0.001", "sf0.01")
    table = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity.score_toxicity(table, labels).filter("held_out").join(labels, "doc_id").cache()
    toxic = got.filter("toxic = 1")
    assert toxic.filter("predicted = 1").count() >= 0.7 * toxic.count()
    clean = got.filter("toxic = 0")
    assert clean.filter("predicted = 1").count() <= 0.05 * clean.count()
    langs = langid.predict_languages(table, fit_rows=150).join(table.select("doc_id", "lang"), "doc_id").filter("held_out and lang_pred <> 'und'")
    assert langs.filter("lang = lang_pred").count() >= 0.97 * langs.count()


def test_toxic_rows_without_a_frequent_toxic_word_have_neighbours(spark):
    rows, labels = [], []
    for i in range(60):
        rows.append((i, f"plain common words here number {'abcdefghij'[i % 10] * 7} again"))
        labels.append((i, 0))
    for i in range(60, 72):                                # each rare word in two toxic rows only
        rows.append((i, f"zor{'abcdef'[(i - 60) // 2] * 6} mux{'abcdef'[(i - 60) // 2] * 5}"))
        labels.append((i, 1))
    train = [i for i in range(72) if zlib.crc32(str(i).encode()) % 3 != 1]
    probe = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 3 == 1)
    pair = next(i for i in train if i >= 60)
    rows.append((probe, dict(rows)[pair]))
    got = {r.doc_id: r for r in toxicity.score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"),
                                                        spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}[probe]
    assert got.evidence and got.evidence[0].toxic == 1 and abs(got.evidence[0].cosine - 1) < 1e-9


def test_toxic_rows_are_found_in_each_language(spark):
    folder = SMALL.replace("sf0.001", "sf0.1")
    table, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    got = toxicity.score_toxicity(table.join(labels.select("doc_id"), "doc_id", "left_semi"), labels).filter("held_out")
    got = got.join(labels, "doc_id").filter("toxic = 1").join(table.select("doc_id", "lang"), "doc_id")
    by = {r.lang: r for r in got.groupBy("lang").agg(F.avg("predicted").alias("recall"),
                                                     F.sum((F.size("evidence") == 0).cast("int")).alias("alone")).collect()}
    print({k: round(r.recall, 3) for k, r in by.items()})
    assert len(by) == 4 and all(r.alone == 0 for r in by.values())       # 12 rows had no neighbour, 3 of them Spanish
    assert all(r.recall > 0.2 for r in by.values()) and by["es"].recall > 0.5


def test_documents_with_several_texts_keep_all_links(spark):
    words = [f"w{i}" for i in range(60)]
    b, c = " ".join(words), " ".join(f"v{i}" for i in range(60))
    rows = [(5, b), (5, c), (9, c), (11, c + " more"), (13, b + " more"), (20, "something else entirely over here now")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(table).collect()}
    assert got == {5: 5, 9: 5, 11: 5, 13: 5, 20: 20}
    table = spark.createDataFrame([(5, b), (5, c), (9, c + " more"), (3, b + " more"), (3, "x y z u v w")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_components(table).collect()} == {5: 3, 9: 3, 3: 3}


SECRETS = ["********", "--------", "пароль", "密码密码密码", "пароль123", "!!!!!!!!!!", "κωδικός99", "########"]


def test_surrogates_of_any_secret_end_and_differ():
    key = b"k"
    for form in SECRETS:
        drawn = {pii.surrogate("secret", form, key, d) for d in range(40)}
        assert len(drawn) >= 39 and form not in drawn                     # every draw is another text
    for kind, form in (("phone", "5551234567"), ("card", "4111111111111111"), ("ip", "1.1.1.1"), ("email", "a@b.com"),
                       ("name_last", "smith"), ("iban", "DE89370400440532013000"), ("hex", "ab")):
        assert len({pii.surrogate(kind, form, key, d) for d in range(40)}) >= 30


def test_many_secrets_of_symbols_get_distinct_surrogates(spark, monkeypatch):
    monkeypatch.setitem(pii._SYLLABLES, "latin", ["ba", "be"])            # a narrow space of names: 2 ** 3 * 5 last names
    rows = [(i, f"password: {s}") for i, s in enumerate(SECRETS * 2)]
    rows += [(100 + i, f"Mr. {n} said so") for i, n in enumerate(f"Q{chr(97 + i % 26)}{chr(97 + i // 26)}lor" for i in range(120))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.pseudonymise(table).collect()}
    found = pii.surrogate_table(table).collect()
    assert len(found) == len({(r.kind, r.new) for r in found})
    assert len({out[100 + i].text for i in range(120)}) == 120            # distinct names stay distinct
    for i, s in enumerate(SECRETS):
        assert out[i].text == out[i + len(SECRETS)].text                  # coreference
        if out[i].n_entities:
            assert s not in out[i].text


def _sparse_examples(rng, count, size, kinds):
    """Examples of several kinds, each with terms of its own and a few shared ones."""
    terms = []
    for i in range(count):
        own = rng.choice(size, rng.integers(2, 9), replace=False) + size * (i % kinds)
        terms.append(sorted({*own.tolist(), *(size * kinds + rng.choice(5, 2)).tolist()}))
    return terms, [rng.integers(1, 4, len(t)).tolist() for t in terms]


@pytest.mark.parametrize("kinds", [1, 6])
def test_block_bounds_find_the_exact_neighbours_and_skip_blocks(kinds, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 32)                           # 600 examples make 19 blocks
    rng = np.random.default_rng(5)
    terms, times = _sparse_examples(rng, 600, 30, kinds)
    ix = toxicity.Index(range(600), rng.integers(0, 2, 600), terms, times, np.log(1 + rng.random(30 * kinds + 5) * 5))
    dense = np.zeros((600, 30 * kinds + 5))
    for i, (t, n) in enumerate(zip(terms, times)):
        a, w = ix.weights(t, n)
        dense[i, a] = w
    for i in range(0, 600, 7):
        who, cos = ix.nearest(terms[i], times[i], but=i)
        s = np.round(dense @ dense[i], 12)
        s[i] = 0
        want = [j for j in np.lexsort((np.arange(600), -s)) if s[j] > 0][:toxicity.NEAREST]
        assert who.tolist() == want and np.allclose(cos, s[want])
    if kinds > 1:
        assert ix.passed > ix.scored                                     # most blocks are never looked at


def test_monotone_rates_pool_neighbours():
    assert toxicity._monotone([0.1, 0.3, 0.2, 0.9], [1, 1, 3, 1]) == pytest.approx([0.1, 0.225, 0.225, 0.9])


def test_long_words_sum_over_all_segmentations():
    trie = langid.Pieces([(i, x) for i, x in enumerate(["▁", "a", "b", "ab", "ba", "aab", "abab", "▁a", "▁ab"])])
    rng = np.random.default_rng(5)
    p = rng.random((10, 2))
    p[-1] = langid.UNKNOWN
    p /= p.sum(axis=0)
    words = ["", "ab", "aabab", "ab" * 23, "ab" * 24, "abc" * 60, "é" * 400, "".join(rng.choice(list("abab?"), 3000))]

    def plain(word, lang):
        word, logs = "▁" + word, [0.0]
        for e in range(1, len(word) + 1):
            ways = [logs[s] + np.log(p[trie.number.get(word[s:e], -1), lang]) for s in range(max(0, e - 4), e)
                    if word[s:e] in trie.number or e == s + 1]
            logs.append(np.logaddexp.reduce(ways))
        return logs[-1]
    got = langid.word_logs(trie, p, words)
    assert np.allclose(got, [[plain(w, k) for k in (0, 1)] for w in words], rtol=1e-12)
    # expected uses are the derivatives of the log sum by the logarithms of the pieces
    for word in words[4:]:
        piece, share = langid.long_uses(trie, p[:, 1], "▁" + word)
        uses = np.bincount(np.where(piece < 0, 9, piece), weights=share, minlength=10)
        for i in (1, 3, 9):
            up, down = p.copy(), p.copy()
            up[i], down[i] = p[i] * np.exp(1e-5), p[i] * np.exp(-1e-5)
            slope = (langid.word_logs(trie, up, [word]) - langid.word_logs(trie, down, [word]))[0, 1] / 2e-5
            assert abs(slope - uses[i]) < 1e-4 * max(1.0, uses[i])
