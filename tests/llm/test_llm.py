import collections
import itertools
import random
import re
import string
import tracemalloc
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from riskframe.llm import batches, exact_dedup, language, mixing, near, packing, pii, quality, simhash, suffix, topk, toxicity
from riskframe.llm import queries as llm
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_sha256 string, keep_id long, at int, cell int"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, 1, "x", 7, 1, 1) for i, t, s in rows], SCHEMA)


WORDS = "the of and to in that is was for it with as his on be at by had not are but from or have an they which one".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(300)) for _ in range(n))


def odd_rows():
    """Null, empty, blank, tiny and long texts, repeated rows, copies, overlapping and periodic repeats."""
    rng = random.Random(4)
    shared, other = sentence(rng, 40), sentence(rng, 60)
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t", None), (4, "x", "b"), (5, "x", "b"), (6, "aaaa" * 120, "a")]
    rows += [(10 + i, f"{sentence(rng, 12)} {shared} {sentence(rng, 9)} {other[i * 7 :]}", "abc"[i % 3]) for i in range(25)]
    rows += [(50, sentence(rng, 30_000) + shared, "a"), (51, "größe é ü " * 40 + shared, None), (52, "größe é ü " * 40, None)]
    rows += [(60 + i, rows[8][1], "c") for i in range(5)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, odd_rows()).repartition(5)


@pytest.fixture(scope="module")
def table(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path())


def test_registered():
    queries = entry.queries()
    assert set(llm.QUERIES) | {"pipeline"} <= set(queries)
    assert sorted(int(n[2:].split("_")[0]) for n in llm.QUERIES) == list(range(1, 11))


# 1


def removed(df):
    return {r["doc_id"]: tuple(r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in df.collect()}


def test_repeats_equal_brute_force(spark, sf_dir, table, docs, monkeypatch):
    assert removed(llm.op1_suffix_dedup(spark, sf_dir)) == brute.repeats(table)
    want = brute.repeats([r[:2] for r in odd_rows()])
    assert removed(suffix.remove_repeats(docs)) == want


def test_repeats_padded_with_nul_bytes(spark):
    """Every window of the passages holds 32 or more NUL bytes."""
    rng = random.Random(6)
    passages = [sentence(rng, 4)[:20] + "\0" * 70 + sentence(rng, 4)[:20], "\0" * 130]
    rows = [(i, f"{sentence(rng, 9)} {passages[i % 2]} {sentence(rng, 7)}", "a") for i in range(8)]
    want = brute.repeats([r[:2] for r in rows])
    assert sum(w[1] > 0 for w in want.values()) >= 6
    assert (suffix.prefix_hashes(np.zeros(64, np.uint8)) != 0).all()
    assert removed(suffix.remove_repeats(frame(spark, rows))) == want


@pytest.mark.parametrize("seed", range(3))
def test_repeats_over_many_ranges_and_runs(spark, seed, monkeypatch):
    rng = random.Random(seed)
    base = [sentence(rng, 50) for _ in range(12)]
    rows = [(i, " ".join(rng.choice(base)[rng.randrange(60) :] + sentence(rng, rng.randrange(4)) for _ in range(3)), "a") for i in range(80)]
    df = frame(spark, rows).repartition(7).selectExpr("doc_id", "cast(text as binary) text")
    spans = suffix.repeated_spans(df, range_bytes=6_000, bucket_bytes=9_000).collect()
    want = brute.repeats([r[:2] for r in rows])
    got = collections.defaultdict(set)
    for r in spans:
        got[r["doc_id"]] |= set(range(r["start"], r["end"]))
    assert {d: len(got[d]) for d, *_ in rows} == {d: w[1] for d, w in want.items()}


def test_loser_tree_merges_with_known_prefixes():
    rng = np.random.default_rng(2)
    runs = []
    for size in (1, 40, 7, 25, 60):
        rows = rng.integers(97, 99, (size, suffix.FULL)).astype(np.uint8)
        rows[:, : suffix.FULL - 6] = 97  # long common prefixes
        runs.append(sorted(r.tobytes() for r in rows))
    lcps = [[0] + [suffix.mismatch(a, b, 0) for a, b in zip(r, r[1:])] for r in runs]
    merged = list(suffix.merge_runs(runs, lcps))
    out = [runs[r][i] for r, i, _ in merged]
    assert out == sorted(sum(runs, []))
    assert [p for *_, p in merged][1:] == [suffix.mismatch(a, b, 0) for a, b in zip(out, out[1:])]


def test_kept_text(docs):
    rows = suffix.remove_repeats(docs, with_text=True).collect()
    assert all(len(r["text"]) == r["n_bytes"] - r["n_removed"] for r in rows)


# 2, 6, 10


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_language_on_the_held_out_fold(spark, sf_dir):
    big = sf_dir.replace("0.001", "0.01")
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{big}/documents.parquet'").fetchall())
    rows = llm.op2_language(spark, big).collect()
    assert len(rows) == len(truth) and all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in rows)
    assert {r["lang_pred"] for r in rows} <= set(truth.values()) | {"und"} and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95


def test_language_edges(docs):
    rows = {r["doc_id"]: r for r in language.identify_language(docs).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 and not rows[i]["accepted"] for i in (1, 2, 3))
    assert rows[50]["lang_pred"] == "en"
    none = language.predict_language(docs, {}).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    narrow = language.predict_language(docs, {"a": b"same words here", "b": b"same words here"}).collect()
    assert not any(r["accepted"] for r in narrow) and {r["lang_pred"] for r in narrow} == {"a", "und"}


def held_out_counts(rows, labels):
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    return collections.Counter(held)


def test_quality_on_the_held_out_fold(spark, sf_dir):
    big = sf_dir.replace("0.001", "0.01")
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{big}/labels.parquet'").fetchall())
    rows = llm.op10_quality(spark, big).collect()
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    counts = held_out_counts(rows, labels)
    assert (counts[0, 0] + counts[1, 1]) / counts.total() > 0.95


@pytest.mark.parametrize("per_class", [5_000, 40], ids=["below the cap", "above the cap"])
def test_quality_cut_covers_all_labelled_rows(spark, sf_dir, per_class):
    big = sf_dir.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    wanted = {i: q for i, q in labels.select("doc_id", "quality").collect() if q in (0, 1) and i is not None and fold(i, 4) != 2}
    rows = [(t or "", wanted[i]) for i, t in docs.select("doc_id", "text").collect() if i in wanted]
    count = collections.Counter(q for _, q in rows)
    assert (max(count.values()) <= per_class) == (per_class == 5_000)
    model = quality.fit_quality(docs, labels, per_class=per_class)
    s = np.sort(model.raw(np.array([quality.features(t) for t, _ in rows])))
    at = count[0]
    assert model.cut == pytest.approx((s[at - 1] + s[at]) / 2, abs=1e-9)
    assert model.spread == pytest.approx(max((np.median(s[at:]) - model.cut) / 4, 1e-3), abs=1e-9)
    before = model.cut
    quality.set_cut(model, docs, labels, "quality", ranked=10)
    assert model.cut == pytest.approx(before, abs=1e-9)


def test_bradley_terry_orders_pairs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    labels = (x @ [2.0, -1.0, 0.0] > 0.5).astype(int)
    model = quality.fit_bradley_terry(x, labels)
    assert ((model.score(x) >= 0.7) == (labels == 1)).mean() > 0.97
    strict = quality.fit_bradley_terry(x, labels, quantile=0.9)
    assert abs((strict.score(x) >= 0.7).mean() - 0.1) < 0.02
    assert quality.fit_bradley_terry(x, np.ones(400, int)) is None


def test_toxicity_on_the_held_out_fold(spark, sf_dir):
    big = sf_dir.replace("0.001", "0.1")
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{big}/labels.parquet'").fetchall())
    counts = held_out_counts(llm.op6_toxicity(spark, big).collect(), labels)
    assert counts[0, 1] / (counts[0, 0] + counts[0, 1]) < 0.05
    assert counts[1, 1] / (counts[1, 0] + counts[1, 1]) > 0.75


def test_network_gradients():
    rng = np.random.default_rng(1)
    net = toxicity.Network(6, 9)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = toxicity.Words(np.array([0, 1, 2, 3, 4, 5]), rng.integers(1, 9, (6, 4)))
    codes, mask = rng.integers(0, 6, (5, 7)), (rng.random((5, 7)) < 0.8).astype(float)
    y, weight = np.array([0, 1, 0, 1, 1.0]), np.ones(5)

    def loss():
        x = net.inputs(words).astype(np.float64)
        p = toxicity.sigmoid(net.logits(tuple(net.projected(x, s) for s in "fb"), codes, mask))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    g = net.gradients(words, codes, mask, y, weight)
    for name in ("Uf", "Wb", "ba", "Wa", "va", "wo", "word", "bf"):
        spot = tuple(int(s) // 2 for s in net.p[name].shape)
        old = net.p[name][spot]
        net.p[name][spot] = old + 1e-3
        up = loss()
        net.p[name][spot] = old - 1e-3
        down = loss()
        net.p[name][spot] = old
        assert abs((up - down) / 2e-3 - g[name][spot]) < 2e-3, name


def test_windows_cover_everything():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        starts = toxicity.windows_of(n)
        assert set(range(n)) <= {s + i for s in starts for i in range(toxicity.WINDOW)}
        assert all(b - a < toxicity.WINDOW for a, b in zip(starts, starts[1:]))


def test_a_late_window_counts():
    rng = random.Random(8)
    texts = [sentence(rng, 90) for _ in range(120)]
    labels = np.array([i % 3 == 0 for i in range(120)], int)
    texts = [t + " vile scumbag" + " " + sentence(rng, 5) if y else t for t, y in zip(texts, labels)]
    model = toxicity.fit_network(texts, labels)
    long = sentence(rng, 3_000)
    scores = model.score(toxicity.Scorer(model).logits([long.split(), (long + " vile scumbag " + long).split(), []]))
    assert scores[1] >= 0.3 > scores[0] and 0 <= scores[2] <= 1


def test_long_tokens_lose_no_character():
    rng = random.Random(9)
    for n in (1, 23, 24, 25, 44, 45, 2_000):
        token = "".join(rng.choice("abcdefgh") for _ in range(n))
        pieces = toxicity.words_of(token)
        assert all(len(p) <= toxicity.LETTERS for p in pieces)
        assert {token[i : i + 5] for i in range(n - 4)} == {p[i : i + 5] for p in pieces for i in range(len(p) - 4)}
    assert toxicity.words_of("one two") == ["one", "two"]


def test_a_late_word_without_spaces_counts():
    rng = random.Random(10)
    texts = [sentence(rng, 60) for _ in range(160)]
    labels = np.array([i % 3 == 0 for i in range(160)], int)
    texts = [t + " vile disgusting scumbag" if y else t for t, y in zip(texts, labels)]
    model = toxicity.fit_network(texts, labels)
    glued = sentence(rng, 400).replace(" ", "")[:1_800]
    both = [glued + "disgustingscumbag" + glued[:150], glued + glued[:180]]
    scores = model.score(toxicity.Scorer(model).logits([toxicity.words_of(t) for t in both]))
    assert scores[0] >= 0.3 > scores[1]


@pytest.mark.parametrize("op", ["quality", "toxicity"])
def test_classifier_edges(spark, docs, op):
    module, fit, score = {
        "quality": (quality, quality.fit_quality, quality.score_quality),
        "toxicity": (toxicity, toxicity.fit_toxicity, toxicity.score_toxicity),
    }[op]
    label = "quality" if op == "quality" else "toxic"
    none = spark.createDataFrame([(4, 1), (None, 0)], f"doc_id long, {label} int")
    assert fit(docs, none) is None
    assert {r["score"] for r in score(docs, None).collect()} == {1.0 if op == "quality" else 0.0}
    some = spark.createDataFrame([(i, i % 2) for i in range(70)], f"doc_id long, {label} int")
    rows = score(docs, fit(docs, some)).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)


# 3


def test_fingerprints_and_components_equal_brute_force(spark, sf_dir, table, docs):
    for rows, df in ((table, llm.op3_simhash(spark, sf_dir)), ([r[:2] for r in odd_rows()], simhash.simhash_groups(docs))):
        fps = {d: brute.fingerprint(t) for d, t in rows}
        want = {d: (f"{fps[d]:016x}", c) for d, c in brute.clusters(fps).items()}
        assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in df.collect()} == want


def test_links_over_many_shards(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(30)]
    fps = {}
    for i in range(900):
        x = rng.choice(centres)
        for _ in range(rng.randrange(5)):
            x ^= 1 << rng.randrange(64)
        fps[i] = x
    rows = [(f - (1 << 64) if f >> 63 else f, i) for f, i in {f: i for i, f in reversed(fps.items())}.items()]
    links = simhash.near_links(spark.createDataFrame(rows, "fp long, id long"), sample=200, shard_rows=60).collect()
    parent = {i: i for _, i in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        x, y = find(r["a"]), find(r["b"])
        parent[max(x, y)] = min(x, y)
    assert {i: find(i) for i in parent} == brute.clusters({i: fps[i] for i in parent})


def test_local_tree_finds_what_pairs_find():
    rng = np.random.default_rng(6)
    fps = np.unique(rng.integers(0, 1 << 63, 40)[rng.integers(0, 40, 4000)] ^ (np.int64(1) << rng.integers(0, 22, 4000)) ^ (np.int64(1) << rng.integers(0, 22, 4000)))
    fps = fps.astype(np.uint64)
    links = simhash.local_links(fps, 2)
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert (int(fps[a]) ^ int(fps[b])).bit_count() <= 2
        parent[max(find(a), find(b))] = min(find(a), find(b))
    want = brute.clusters({i: int(f) for i, f in enumerate(fps)})
    assert [find(i) for i in range(len(fps))] == [want[i] for i in range(len(fps))]


# 4


def test_exact_dedup_survives_collisions(spark, docs):
    from pyspark.sql import functions as F

    def rows(**options):
        return sorted(tuple(r) for r in exact_dedup.exact_dedup(docs, keep="max", **options).collect())

    everything_collides = rows(digest=lambda text: F.md5(F.lit("") if text is None else F.substring(text, 1, 0)))
    assert rows() == everything_collides
    smallest = {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_dedup(docs).collect()}
    assert smallest[2] == 1 and smallest[5] == 4 and smallest[3] == 3 and smallest[64] == smallest[60]
    null_ids = frame(spark, [(None, "t", "a"), (3, "t", "a"), (None, "u", "a")])
    assert sorted((r["keep_id"] or 0, r["kept"]) for r in exact_dedup.exact_dedup(null_ids).collect()) == [(0, True), (3, False), (3, True)]


# 5


def digest_rows(df):
    return {r["doc_id"]: r for r in pii.span_digest(df).collect()}


ODD_TEXTS = [
    "a@b.c_d@e.f x..y@z.com.", "mail bob@mail.example.org, a.b+c@d-e.f.g- and @x.y z@w", "1.2.3.4.5 300.1.1.1 001.02.3.255 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (555) 010-99 99, +12 34 +1((((", "é́ ü 10.0.0.1 é +49 170 1234567",
    "9" * 30_000, "a" * 50_000, "1." * 20_000, ("x@y." * 8_000), "+1" + "(" * 30_000, "7 " * 30_000,
]


def test_personal_spans_equal_brute_force(spark, sf_dir, table):
    import hashlib

    odd = frame(spark, [(i, t, "a") for i, t in enumerate([None, "", *ODD_TEXTS])])
    for rows, df in ((table, pii.sanitisation_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))), (list(enumerate([None, "", *ODD_TEXTS])), pii.sanitisation_spans(odd))):
        got = digest_rows(df)
        for doc_id, text in rows:
            want = brute.personal(text)
            r = got[doc_id]
            assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (doc_id, want, r["spans"])
            assert r["spans"].startswith(",".join(want))
            assert [r[f"n_{k}"] for k in brute.PATTERNS] == [sum(w.startswith(k + ":") for w in want) for k in brute.PATTERNS]


def test_disclosing_words(spark):
    rows = [(i, f"note number{i} plain words here", "a") for i in range(40)]
    rows += [(100 + i, f"please call Zebedee at zed@mail.example.com about plain words{i}", "a") for i in range(4)]
    spans = digest_rows(pii.sanitisation_spans(frame(spark, rows)))
    assert all(spans[i]["spans"] == "" for i in range(40))
    text = rows[-1][1]
    marked = {p.split(":")[0]: text[int(p.split(":")[1]) : int(p.split(":")[2])] for p in spans[103]["spans"].split(",")}
    assert marked["email"] == "zed@mail.example.com" and "removed" in marked and "plain" not in spans[103]["spans"]
    words = {text[int(p.split(":")[1]) : int(p.split(":")[2])] for p in spans[103]["spans"].split(",")}
    assert "Zebedee" in words and "plain" not in words and "words3" not in words
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, rows)).collect()}
    assert "[EMAIL]" in clean[103] and "Zebedee" not in clean[103] and "plain" in clean[103] and clean[0] == rows[0][1]


def test_disclosing_words_go_wherever_they_stand(spark):
    """At the head of a long text whose address stands at its end; not in a text without the address."""
    rows = [(i, f"note number{i} plain words here", "a") for i in range(40)]
    rows += [(100 + i, f"please call Zebedee at zed@mail.example.com about plain words{i}", "a") for i in range(4)]
    far = "Zebedee (ZEBEDEE!) wrote " + "plain words " * 60 + "zed@mail.example.com zebedee.x@mail.example.com, Zebedee"
    rows += [(200, far, "a"), (201, "Zebedee alone", "a"), (200, far, "b")]
    spans = digest_rows(pii.sanitisation_spans(frame(spark, rows)))
    removed = [far[int(p.split(":")[1]) : int(p.split(":")[2])] for p in spans[200]["spans"].split(",") if p.startswith(("removed", "generalised"))]
    assert removed == ["Zebedee", "ZEBEDEE", "Zebedee"] and spans[201]["spans"] == ""
    clean = [r["text"] for r in pii.sanitise(frame(spark, rows)).filter("doc_id = 200").collect()]
    assert len(clean) == 2 and all("zebedee" not in t.lower() and "plain words" in t for t in clean)


def test_shares_equal_plain_counts(spark, sf_dir):
    """The share of every pair, from the definition, over a real table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rules = pii.Disclosure(generalise=0.3)
    found = pii.find_entities(docs, rules)
    near = pii.neighbours(found, rules)
    got = {(r["entity"], r["term"]): r["share"] for r in pii.disclosing_terms(docs, found, near, rules).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    words = collections.Counter(w for t in texts.values() for w in set(re.findall(r"[^\W_]{3,}", t.lower())))
    holders, beside = collections.defaultdict(set), collections.defaultdict(set)
    names = {(r["kind"], r["value"]): r["h"] for r in found.selectExpr("explode(spans) s").selectExpr("s.kind", "s.value", "xxhash64(s.kind, s.value) h").collect()}
    for doc, text in texts.items():
        spans = [p.split(":") for p in brute.personal(text)]
        spans = [(k, int(a), int(b)) for k, a, b in spans]
        for kind, a, b in spans:
            entity = names[kind, text[a:b]]
            holders[entity].add(doc)
            for m in re.finditer(r"[^\W_]{3,}", text):
                whole = (a - 48 < m.start() or m.start() == a - 48 == 0 or a <= 48) and m.end() <= a or m.start() >= b and m.end() < b + 48
                if whole and not any(x < m.end() and m.start() < y for _, x, y in spans):
                    beside[entity, m.group().lower()].add(doc)
    want = {}
    for (entity, term), docs_of in beside.items():
        if len({texts[d] for d in docs_of}) >= rules.support:
            information = np.log2(len(texts) / len(holders[entity]))
            share = np.log2(len(docs_of) * len(texts) / (len(holders[entity]) * words[term])) / information
            if share >= rules.generalise:
                want[entity, term] = share
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


def test_many_numbers_take_linear_time(spark):
    import time

    text = ", ".join(str(10 + i % 90) for i in range(200_000)) + " call +1 (555) 123-4567 or a@b.example"
    df = frame(spark, [(1, text, "a"), (2, "plain", "a")])
    start = time.monotonic()
    spans = digest_rows(pii.sanitisation_spans(df))
    assert spans[1]["spans"].count("phone") == 1 and spans[1]["spans"].count("email") == 1
    assert time.monotonic() - start < 120


# 7


def test_mix_meets_targets(spark, docs):
    rows = mixing.mix(docs, rows_per_range=3).collect()
    assert len(rows) == docs.count()
    by_target = collections.defaultdict(lambda: [0, 0])
    for r in rows:
        by_target[r["target"]][0] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(abs(t - got) < 1 for t, (got, _) in by_target.items())
    assert sorted(rows) == sorted(mixing.mix(docs.repartition(3), rows_per_range=1_000_000).collect())


# 8


def test_pieces_and_bins(spark, sf_dir, table, docs, tokenizer):
    for rows, df in ((table, llm.op8_packing(spark, sf_dir)), ([r[:2] for r in odd_rows()], packing.pack_sequences(docs, pieces_per_part=9))):
        out = df.collect()
        assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in out} == brute.pieces(rows, tokenizer)
        sequences = collections.defaultdict(list)
        for r in out:
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        for parts in sequences.values():
            ends = np.cumsum([0] + [n for _, n in sorted(parts)])
            assert [o for o, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= 4096
        assert len(sequences) <= -(-sum(r["length"] for r in out) // 4096) + 4


def test_words_are_enough_for_the_tokenizer(tokenizer, monkeypatch):
    texts = ["Don't stop now x\x1cy\x85z", "ΣΑΣ ΟΔΟΣ ς", "é ́a", "a\r\n\tb\x0b\x0cc", "<|endoftext|> x<|startoftext|>y", "naïve — “q” 123,45", "  "]
    words = packing.WordTokenizer(packing.tokenizer_path())
    monkeypatch.setattr(packing, "CACHED_WORDS", 5)
    for part in (texts[:2], texts[2:], texts):
        for t, ids in zip(part, words.ids(part)):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_words_of_known_parts_are_not_encoded_again(tokenizer):
    """Words are put together from parts; ids stay those of the whole text."""
    rng = random.Random(8)
    signs = ["'s", "'T", "'re", "''", "'", "7", "42", "&&&", ".", "<|endoftext|>", "<|EndOfText|>", "ß", "É", "ÀÑ", "×", "µ", "e\u0301", "İ", "ſ", "\x1c", "\r", "²", "abc", "Don", "ЖЖ"]
    texts = [" ".join("".join(rng.choices(signs, k=rng.randrange(1, 6))) for _ in range(40)) for _ in range(200)]
    words = packing.WordTokenizer(packing.tokenizer_path())
    for t, ids in zip(texts, words.ids(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    list(words.ids(["Über die Brücke, abc's 1 2 3"]))
    seen = len(words.parts)
    list(words.ids(["über Die, brücke! abc 321'S ABC,über"]))
    assert words.in_parts and len(words.parts) == seen + 1  # the exclamation mark


def test_a_worker_keeps_few_words(monkeypatch):
    """Kept words are bounded inside a text too, and the two stores fit beside the JVM; words in use stay."""
    names = ["".join(n) for n in itertools.product("abcdefghij", *[string.ascii_letters[:33]] * 3)]
    words = packing.WordTokenizer(packing.tokenizer_path())
    tracemalloc.start()
    for end in ".,":
        list(words.ids([" ".join(n + end for n in names[at : at + 10_000]) for at in range(0, len(names), 10_000)]))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 80e6
    monkeypatch.setattr(packing, "CACHED_WORDS", 10)
    words = packing.WordTokenizer(packing.tokenizer_path())
    text = " ".join(f"often {n}" for n in names[:1_000])
    list(words.ids([text]))
    assert len(words.known) <= 10 and len(words.parts) <= 10
    made = collections.Counter()
    words.known.make = lambda w, make=words.known.make: made.update([w]) or make(w)
    list(words.ids([text]))
    assert max(len(words.known.old), len(words.parts.old)) <= 10 and made["often"] == 0


def test_bounds_and_best_fit():
    rng = np.random.default_rng(0)
    for high in (10, 40, 100):
        sizes = rng.integers(1, high + 1, 200)
        bins, offsets, count = packing.best_fit(sizes, 100)
        assert np.bincount(bins, weights=sizes).max() <= 100 and count >= packing.lower_bound(sizes, 100) >= -(-sizes.sum() // 100)
    assert packing.lower_bound(np.array([51, 51, 51]), 100) == 3
    assert packing.lower_bound(np.array([34, 34, 34]), 100) == 2


# 9


@pytest.mark.parametrize("shape", ["dense", "sparse", "ties"])
def test_topk_equals_brute_force(spark, shape):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 12))
    if shape == "sparse":
        x *= rng.random(x.shape) < 0.2
    if shape == "ties":
        x = rng.integers(-1, 2, x.shape) / 4
    q = np.floor(256 * x).astype(int)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(900, None), (901, [1.0, None]), (902, [float("nan")] * 12), (903, [float("inf")] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = topk.exact_topk(df, df.filter("vec_id % 50 = 0"), 5, shard_rows=90, query_rows=3).collect()
    want = []
    for a in range(0, 400, 50):
        scores = sorted((-int(q[a] @ q[b]), b) for b in range(400) if b != a)[:5]
        want += [(a, n + 1, b, -s) for n, (s, b) in enumerate(scores)]
    assert sorted(tuple(r) for r in got) == want


@pytest.mark.parametrize("size", [400_000, 10**6, 3_000_000])
def test_topk_adds_large_components_exactly(spark, size):
    rng = random.Random(size)
    rows = [(i, [float(rng.randrange(-size, size)) + rng.randrange(256) / 256 for _ in range(5)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.exact_topk(df, df.filter("vec_id % 20 = 0"), 3).collect()
    whole = {i: [int(256 * x // 1) for x in v] for i, v in rows}
    want = []
    for q in (0, 20, 40):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)[:3]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)


@pytest.mark.parametrize("size", [3e15, 1e300])
def test_topk_refuses_what_no_long_holds(spark, size):
    df = spark.createDataFrame([(0, [size, 1.0]), (1, [size, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="components too large"):
        topk.exact_topk(df, df, 1).collect()


def test_topk_of_few_rows(spark):
    df = spark.createDataFrame([(0, [0.5]), (1, [0.25, 1.0]), (2, [])], "vec_id long, embedding array<float>")
    got = topk.exact_topk(df, df.filter("vec_id = 0"), 5).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 1, 128 * 64), (0, 2, 2, 0)]


def test_topk_counts_rows_not_ids(spark):
    """Rows that repeat an id or a whole row, a null id: every row but the query's own is a candidate, of any size."""
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(-50, 60)]), [float(rng.randrange(-3, 4)) for _ in range(3)]) for _ in range(300)]
    rows += rows[:40] + [(0, [1.0, 2.0, 3.0]), (0, [3.0, 2.0, 1.0]), (0, [1.0, 2.0, 3.0]), (70, []), (71, [0.0, 0.0, 0.0, 1e300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.exact_topk(df, df.filter("vec_id % 50 = 0"), 5, shard_rows=60, query_rows=4).collect()
    want = []
    for n, (a, v) in enumerate(rows):
        if a is not None and a % 50 == 0:
            others = [(-sum(int(256 * x) * int(256 * y) for x, y in zip(v, w)), b is None, b or 0) for m, (b, w) in enumerate(rows) if m != n]
            want += [(a, r, None if null else b, -s) for r, (s, null, b) in enumerate(sorted(others)[:5], 1)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_topk_adds_what_a_long_holds_beside_larger_numbers(spark):
    """Scores up to the largest long are exact; what is too low for one is left behind, an error only in the result."""
    big = 2.0**54
    rows = [(0, [big / 256, 2.0, 0.0]), (1, [0.0, 1.0, 5.0]), (2, [-big, 1.0, 5.0]), (3, [2.0**9 / 256 - 2, 3.0, 1.0]), (4, [1.0, 0.5, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.exact_topk(df, df.filter("vec_id = 0"), 3).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 4, 2**62 + 512 * 128), (0, 2, 3, 512 * 768), (0, 3, 1, 512 * 256)]
    with pytest.raises(Exception, match="components too large"):
        topk.exact_topk(df, df.filter("vec_id = 0"), 4).collect()


# tables without rows, repeated rows, null ids


@pytest.mark.parametrize("rows", [[], [(None, None, None), (None, "a text of words", "s"), (1, "one two", "s"), (1, "one two", "s"), (1, "other", "s")]], ids=["empty", "odd ids"])
def test_every_operator_takes_odd_tables(spark, rows):
    df = frame(spark, rows)
    results = [
        suffix.remove_repeats(df), language.identify_language(df), simhash.simhash_groups(df), exact_dedup.exact_dedup(df),
        pii.span_digest(pii.sanitisation_spans(df)), toxicity.score_toxicity(df, None), mixing.mix(df), packing.pack_sequences(df),
        quality.score_quality(df, None),
    ]
    assert [r.count() for r in results] == [len(rows)] * len(results)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.exact_topk(vectors, vectors, 5).count() == 0


# pipeline


def test_near_dedup_stage_equals_brute_force(spark, sf_dir, docs):
    """A planted text with one to eight replaced words, its repeated row, a repeated id and null ids, and real tables."""
    rng = random.Random(8)
    base = sentence(rng, 150).split()
    rows = []
    for i in range(40):
        words = list(base)
        for at in rng.sample(range(150), 1 + i % 8):
            words[at] = f"new{i}x{at}"
        rows.append((100 + i, " ".join(words), "a"))
    rows += [rows[0], rows[0], (100, sentence(rng, 80), "a"), (None, " ".join(base), "a"), (None, sentence(rng, 20), "a"), (None, None, "b")]
    odd = frame(spark, rows).repartition(4).union(docs)
    for df in (odd, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        ordered = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, zlib.crc32((r[1] or "").encode())))
        groups = brute.near_groups([r[1] for r in ordered])
        members = collections.defaultdict(list)
        for r, g in zip(ordered, groups):
            members[g].append(r[0] if r[0] is not None else float("inf"))
        kept = corpus_pipeline.near_dedup_stage(spark, df, sf_dir)
        assert kept.columns == df.columns
        got = [r["doc_id"] if r["doc_id"] is not None else float("inf") for r in kept.collect()]
        assert sorted(got) == sorted(min(ids) for ids in members.values())
        assert len(got) < df.select("text").distinct().count()


def test_similar_pairs_shuffle_only_texts_of_pairs(spark, tmp_path):
    """Texts that are in no pair are not dealt to tasks."""
    rng = random.Random(3)
    texts = [sentence(rng, 60) for _ in range(40)]
    spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts + texts[:2])], "at long, text binary").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    pairs = spark.createDataFrame([(0, 40), (1, 41), (0, 1)], "a long, b long")
    found = near.similar_pairs(pairs, rows, 5, 0.8)
    assert sorted(map(tuple, found.collect())) == [(0, 40), (1, 41)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftSemi") >= 2


def test_parities_bound_the_difference_of_sets():
    rng = np.random.default_rng(4)
    for n, changed in [(1, 1), (40, 3), (300, 30), (300, 300), (5000, 900), (0, 7)]:
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[changed:], rng.integers(0, 1 << 63, changed, dtype=np.uint64)]))
        bits = int(np.bitwise_count(near.parities(a) ^ near.parities(b)).sum())
        assert bits <= len(np.setxor1d(a, b))
        if (n, changed) == (300, 300):  # different texts are told apart
            assert bits > (len(a) + len(b)) / 9


def test_near_dedup_rounds_carry_no_prefixes(spark, monkeypatch):
    """Texts just above and below the similarity, some with more shingles apart than parities: tables between rounds hold numbers only."""
    rng = random.Random(12)
    rows = []
    for width, places in ((150, range(1, 13)), (3000, (30, 45))):
        base = sentence(rng, width).split()
        for i in range(24):
            words = list(base)
            for at in rng.sample(range(width), places[i % len(places)]):
                words[at] = f"new{i}x{at}"
            rows.append((len(rows), " ".join(words), "a"))
    kinds, compared = [], []

    def kept(df, name, write=near.materialize):
        out = write(df, name)
        if name == "near_open":
            kinds.append({kind for _, kind in df.dtypes})
        if name == "near_pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(near, "materialize", kept)
    batches.prepare(spark)
    got = near.drop_near_copies(frame(spark, rows)).collect()
    groups = brute.near_groups([r[1] for r in rows])
    assert sorted(r["doc_id"] for r in got) == sorted(set(groups))
    assert 2 < len(got) < len(rows) - 10
    assert len(kinds) > 1 and set.union(*kinds) <= {"bigint", "int"}
    assert sum(compared) < 24 * 24


def test_components_grow_by_links_between_them(spark, monkeypatch):
    """Two rounds of random links give the components of all; the second follows links between components only."""
    rng = random.Random(6)
    rounds = [[tuple(sorted(rng.sample(range(120), 2))) for _ in range(n)] for n in (70, 25)]
    rounds[1] += rounds[0][:40]
    followed, groups, known = [], None, set()

    def count(edges, find=near.components):
        followed.append(edges.filter("a != b").distinct().count())
        return find(edges)

    monkeypatch.setattr(near, "components", count)
    for links in rounds:
        groups = near.grown(groups, spark.createDataFrame(links, "a long, b long"))
        known |= set(links)
        parent = {n: n for pair in known for n in pair}
        for _ in parent:
            for a, b in known:
                parent[a] = parent[b] = min(parent[a], parent[b])
        rows = groups.collect()
        assert {r["node"]: r["component"] for r in rows} == parent and len(rows) == len(parent)
    assert followed[0] == len(set(rounds[0])) and followed[1] <= 25


def test_pipeline_stages(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, sf_dir)
        if name == "packing":
            out = got.collect()
            want = brute.pieces([(r[0], r[1]) for r in rows], tokenizer)
            assert collections.Counter((r["doc_id"], r["piece"]) for r in out) == collections.Counter(
                k for r in rows for k in want if k[0] == r[0]
            )
            break
        assert got.columns == docs.columns
        kept = [tuple(r) for r in got.collect()]
        if name == "quality":
            scores = {r["doc_id"]: r["predicted"] for r in quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()}
            want_rows = [r for r in rows if scores[r[0]] == 1]
        elif name == "exact_dedup":
            last = {}
            for r in sorted(rows):
                last[r[1] or ""] = r
            want_rows = list(last.values())
        elif name == "near_dedup":
            rows.sort()
            want_rows = [r for i, (r, g) in enumerate(zip(rows, brute.near_groups([r[1] for r in rows]))) if g == i]
        else:
            taken = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) if r["size"] else 0 for r in mixing.mix(docs).collect()}
            want_rows = [r for r in rows for _ in range(taken[r[0]])]
        assert sorted(kept, key=str) == sorted(want_rows, key=str), name
        rows, docs = kept, spark.createDataFrame(kept, docs.schema)
    assert corpus_pipeline.run(spark, sf_dir).count() == len(out)
