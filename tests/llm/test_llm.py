"""Each operator against plain versions, and its edge cases."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from windrow.llm import (
    bpe, components, kneser_ney, langid, mixing, quality, simhash, substrings, suffixes, token_counts, topk,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, repeats within a text, empty, null, blank and long texts."""
    rng = random.Random(7)
    passage, long = words(rng, 45), words(rng, 3000)
    texts = [words(rng, rng.randrange(1, 120)) for _ in range(40)]
    texts += [texts[3], texts[3], texts[5].upper(), texts[7] + " more", long, long + " tail", "x" * 4000, "x" * 4100]
    texts += [words(rng, 30) + " " + passage + "\n" + words(rng, 25) for _ in range(8)]
    texts += ["same " * 60, "", None, " \t\n", "one", "é" * 60 + " ü", "Ünï " + "é" * 60, "a  b\n\n c <|endoftext|> d 😀"]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(i, texts[k]) for i, k in enumerate(order)]


@pytest.fixture(scope="module")
def documents(spark, rows):
    # Columns whose names operators use themselves.
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    clash = ("chunk", "part", "rows", "_row", "_key", "_text", "fp", "root", "digest", "measures", "weight", "ids")
    return table.select("*", *[F.lit("own").alias(c) for c in clash]).persist()


@pytest.fixture(scope="module")
def none(documents):
    return documents.limit(0)


def test_bpe_gives_the_librarys_ids_and_comes_back(documents, rows):
    library = Tokenizer.from_file(PATH)
    found = {r["doc_id"]: (r["ids"], r["decoded"]) for r in bpe.round_trip(documents, PATH).collect()}
    assert found == {i: (library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows}
    encoded = bpe.encode(documents, PATH)
    assert {r["doc_id"]: r["text"] for r in bpe.decode(encoded, PATH).collect()} == {i: t or "" for i, t in rows}


def test_bpe_on_any_text():
    rng = random.Random(1)
    library, codec = Tokenizer.from_file(PATH), bpe.Codec(open(PATH, encoding="utf-8").read())
    parts = ["a", "ing", " ", "  ", "\n", "\t", "é", "汉字", "<|endoftext|>", "12", "!", "'s", "'", "x" * 90, "\x85", "\x1c", "͸"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(300)]
    ids = codec.encode(texts)
    assert ids.to_pylist() == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert codec.decode(ids).to_pylist() == texts
    assert codec.decode(codec.encode([])).to_pylist() == []
    part = codec.encode(["é"]).to_pylist()[0][:1]
    assert codec.decode(bpe.pa.array([part], bpe.pa.large_list(bpe.pa.int32()))).to_pylist() == [library.decode(part)]
    with pytest.raises(ValueError, match="vocabulary"):
        codec.decode(bpe.pa.array([[10**6]], bpe.pa.large_list(bpe.pa.int32())))


def test_language_id(spark, none):
    texts = {"en": "the cat and the dog of this house", "fr": "le chat et les chiens de cette maison", "de": "der hund und die katze das haus"}
    rng = random.Random(3)
    mixed = lambda lang, n: " ".join(rng.choices(texts[lang].split(), k=n))
    labelled = [(i, mixed(lang, 40), lang) for i, lang in enumerate(list(texts) * 10)] + [(99, None, "en"), (98, "x", None)]
    model = langid.train(spark.createDataFrame(labelled, "doc_id int, text string, lang string"))
    assert model.languages == ["de", "en", "fr"]
    pages = []
    for i, lang in enumerate(["en", "fr", "de"] * 30):
        claim = f' lang="{lang}"' if i % 2 else ""
        pages.append((i, f"http://{lang}.example.{lang}/a", f"<html{claim}><script>der die</script><p>{mixed(lang, 30)}</p></html>"))
    pages += [(200, "http://fr.example.fr/b", None), (201, None, ""), (202, None, f"<p>{mixed('de', 20)}"), (203, "::", "<html lang=xx>")]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("host", F.lit("own"))
    found = {r["page_id"]: r for r in langid.identify(table, model).collect()}
    assert len(found) == len(pages)
    assert all(found[i]["lang"] == ["en", "fr", "de"][i % 3] for i in range(90))
    assert found[200]["lang"] == "fr" and found[202]["lang"] == "de" and found[201]["lang"] is not None
    assert all(0 < r["probability"] <= 1 for r in found.values())
    assert langid.identify(table.limit(0), model).count() == 0
    empty = langid.train(none.withColumn("lang", F.lit("en")))
    assert {r["lang"] for r in langid.identify(table, empty).collect()} == {None}


@pytest.mark.parametrize("order", [2, 3])
def test_kneser_ney(spark, rows, documents, none, order):
    learn = F.col("doc_id") % 5 != 0
    found, model = kneser_ney.learn_and_score(documents, learn, order=order, chunk_bytes=3000)
    names = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    got = sorted(map(tuple, found.select(*names).collect()))
    want = brute.kneser_ney([(i, t, i % 5 != 0) for i, t in rows], order)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4:] for g in got] == [pytest.approx(w[4:], rel=1e-9) for w in want]
    again = kneser_ney.score(documents.repartition(2), model, chunk_bytes=9000).select(*names)
    assert sorted(map(tuple, again.collect())) == [pytest.approx(g, rel=1e-12) for g in got]
    if order == 2:
        assert kneser_ney.learn_and_score(none, learn)[0].count() == 0
        untaught = kneser_ney.learn_and_score(documents, F.lit(None).cast("boolean"))[0]
        assert untaught.agg(F.max("n_known"), F.max("score")).first() == (0, 0.0)


def test_kneser_ney_beats_the_base_on_held_out_text(spark):
    rng = random.Random(5)
    pairs = {f"w{i}": [f"w{rng.randrange(50)}" for _ in range(3)] for i in range(50)}
    texts = []
    for i in range(200):
        text = [f"w{rng.randrange(50)}"]
        while len(text) < 40:
            text.append(rng.choice(pairs[text[-1]]))
        texts.append((i, " ".join(text)))
    found, _ = kneser_ney.learn_and_score(spark.createDataFrame(texts, "doc_id int, text string"), F.col("doc_id") % 10 != 0)
    held = found.where("not learnt").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > 0.5 * held[1]


def test_mixing_reaches_its_targets(spark, none):
    rng = random.Random(2)
    source = lambda: "big" if rng.random() < 0.4 else f"s{rng.randrange(5)}"
    docs = [(i, source(), rng.choice(["en", "fr", None]), rng.randrange(0, 200), "own") for i in range(3000)]
    docs += [(None, None, "en", None, "own")]
    table = spark.createDataFrame(docs, "doc_id bigint, source string, lang string, n_tokens bigint, probability string")
    targets = {
        "source": lambda cells: mixing.smoothed(cells, "source", 0.3),
        "lang": lambda cells: mixing.fixed(cells, {"en": 0.6, "fr": 0.3, "absent": 0.5}),
    }
    found = mixing.mix(table, targets).persist()
    assert found.count() == len(docs) and found.where("probability is null or probability not between 0 and 1").count() == 0
    own = found.where("lang is null").agg(F.sum("n_tokens")).first()[0] / found.agg(F.sum("n_tokens")).first()[0]
    mass = {r[0]: r[1] for r in found.groupBy("lang").agg(F.sum(F.col("weight") * F.col("n_tokens"))).collect()}
    shares = {k: v / sum(mass.values()) for k, v in mass.items()}
    assert shares[None] == pytest.approx(own) and shares["en"] / shares["fr"] == pytest.approx(2)
    tokens = {r[0]: r[1] for r in found.where("sampled").groupBy("lang").agg(F.sum("n_tokens")).collect()}
    assert tokens["en"] / sum(tokens.values()) == pytest.approx(shares["en"], abs=0.08)
    assert found.agg(F.max("remaining")).first()[0] <= mixing.TOLERANCE
    # Targets that contradict each other: languages that each have one source only.
    clash = spark.createDataFrame([(1, "a", "en", 10), (2, "b", "fr", 10)], "doc_id bigint, source string, lang string, n_tokens bigint")
    against = {"source": lambda c: mixing.fixed(c, {"a": 0.9, "b": 0.1}), "lang": lambda c: mixing.fixed(c, {"en": 0.1, "fr": 0.9})}
    assert mixing.mix(clash, against).first()["remaining"] > 0.1
    empty = none.select("doc_id", F.lit("a").alias("source"), F.lit("b").alias("lang"), F.lit(1).alias("n_tokens"))
    assert mixing.mix(empty, targets).count() == 0


def test_many_copies_and_cells_without_tokens(spark):
    table = spark.createDataFrame([(1, 200, "x"), (2, 64, "x"), (3, 0, "x"), (4, 65, None)], "doc_id bigint, copies bigint, copy string")
    found = mixing.repeated(table.drop("copy")).groupBy("doc_id").agg(F.count("*"), F.countDistinct("copy"), F.min("copy"), F.max("copy"))
    assert sorted(map(tuple, found.collect())) == [(1, 200, 200, 0, 199), (2, 64, 64, 0, 63), (4, 65, 65, 0, 64)]
    cells = spark.createDataFrame([("a", 100.0, 1.0), ("b", 0.0, 7.0), ("c", 0.0, 0.2)], "source string, tokens double, weight double")
    chances = {r["source"]: r["probability"] for r in mixing.expected_copies(cells, 0.5).collect()}
    assert chances == {"a": 0.5, "b": 1.0, "c": 0.1}
    none = mixing.expected_copies(cells.where("tokens = 0"), 0.5)
    assert {r["probability"] for r in none.collect()} == {0.0}


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    rng = np.random.default_rng(0)
    vectors = rng.normal(0, 0.2, (300, 20)).round(1)  # many ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(300, None), (301, [None] * 20), (302, [float("nan")] * 20), (303, []), (None, [1.0] * 20), (304, vectors[0].tolist())]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    whole = table.select("vec_id", topk.floored("embedding").alias("vector"))
    found = {}
    for r in topk.top_k(whole, whole.where("vec_id % 10 = 0"), 7).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    own = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in rows if i not in (None, 300, 301, 302, 303)}
    own[303] = np.zeros(20, int)
    for q in range(0, 300, 10):
        scores = sorted((-int(own[q] @ v), i) for i, v in own.items() if i != q)
        assert found[q] == [(i, -s) for s, i in scores[:7]]
    assert topk.top_k(whole.limit(0), whole, 3).count() == 0 and topk.top_k(whole, whole.limit(0), 3).count() == 0
    few = whole.where("vec_id < 3")
    assert topk.top_k(few, few, 10).count() == 6
    huge = spark.createDataFrame([(i, [1e17 * (i + 1), 1.0]) for i in range(4)], "vec_id bigint, embedding array<double>")
    huge = huge.select("vec_id", topk.floored("embedding").alias("vector"))
    assert [r["vec_id"] for r in topk.top_k(huge, huge.where("vec_id = 0"), 3).orderBy("rank").collect()] == [1, 2, 3]


@pytest.mark.parametrize("hot", [4096, 3])
def test_substring_and_suffix_dedup(rows, documents, none, monkeypatch, hot):
    from windrow.llm import repeats

    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "SEGMENT", 1000)
    found = substrings.remove_repeats(documents, chunk_bytes=4000)
    got = [(r["doc_id"], r["n_words"], r["n_removed"], brute.sha(r["kept"])) for r in found.collect()]
    assert sorted(got) == brute.substring_dedup(rows)
    found = suffixes.remove_repeats(documents, carry=("digest",), chunk_bytes=4000)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], brute.sha(bytes(r["kept"]))) for r in found.collect()]
    assert sorted(got) == brute.suffix_dedup(rows)
    if hot == 3:
        assert substrings.remove_repeats(none).count() == 0 and suffixes.remove_repeats(none).count() == 0


def test_dedup_of_repeated_and_null_keys(spark):
    text = " ".join(f"v{i}" for i in range(30))
    table = spark.createDataFrame([(None, text), (1, text), (1, text), (2, text + " end")], "doc_id bigint, text string")
    found = substrings.remove_repeats(table).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in found) == [(0, 0), (1, 30), (1, 30), (2, 30)]
    same = substrings.remove_repeats(table.where("doc_id = 1")).collect()
    assert [r["n_removed"] for r in same] == [0, 0]
    assert {r["n_removed"] for r in suffixes.remove_repeats(table.where("doc_id = 1")).collect()} == {0}


def test_suffix_arrays():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 500).astype(np.uint8)
    at = np.arange(480)
    order, _ = suffixes.suffix_order(data, at, 20)
    texts = [data[i : i + 20].tobytes() for i in at]
    assert [texts[i] for i in order] == sorted(texts)
    document = at // 100
    longest = suffixes.longest_previous(data, at, document, 20)
    for i in at:
        common = [next((k for k in range(20) if texts[i][k] != texts[j][k]), 20) for j in at[document < document[i]]]
        assert longest[i] == max(common, default=0)
    position = rng.integers(0, 9, 50)
    for i, j in enumerate(suffixes.nearest_smaller(position)):
        assert j == max((k for k in range(i) if position[k] < position[i]), default=-1)


@pytest.mark.parametrize("hot", [4096, 2])
def test_simhash(rows, documents, none, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    found = simhash.near_duplicates(documents).select("doc_id", simhash.hexadecimal(), "component")
    assert sorted(map(tuple, found.collect())) == brute.simhash(rows)
    if hot == 2:
        assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("bits", [2, 4, 7])
def test_covering_code_finds_every_link(spark, bits, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 50)
    rng = np.random.default_rng(bits)
    prints = set()
    for base in rng.integers(0, 2**63, 40).tolist():
        for _ in range(8):
            x = base
            for k in rng.choice(64, rng.integers(0, 10), replace=False):
                x ^= 1 << int(k)
            prints.add(x - (1 << 64) if x >= 1 << 63 else x)
    prints = sorted(prints)
    links = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp bigint"), bits)
    pairs = links.collect()
    assert all(0 < ((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= bits for r in pairs)
    found = {r["node"]: r["root"] for r in components.connected(links).collect()}
    near = [(i, j) for i in range(len(prints)) for j in range(i) if ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= bits]
    root = components.local_roots(len(prints), *(np.array([p[k] for p in near], int) for k in (0, 1)))
    assert all(found.get(p, p) == prints[root[i]] for i, p in enumerate(prints))


def test_components(spark):
    rng = random.Random(0)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5), (None, 3)]
    found = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    pairs = [(a, b) for a, b in links if a is not None and a != b]
    root = components.local_roots(500, *(np.array([p[k] for p in pairs]) for k in (0, 1)))
    assert found == {i: int(root[i]) for i in {x for p in pairs for x in p} if root[i] != i}


def test_keep_one(spark, rows):
    table = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit(1)).withColumn("_row", F.lit("own"))
    kept = simhash.keep_one(table.repartition(5))
    assert kept.columns == ["doc_id", "text", "fp", "_row"]
    texts = dict(rows)
    found = {r["doc_id"]: (r["text"], r["fp"], r["_row"]) for r in kept.collect()}
    assert found == {c: (texts[c], 1, "own") for c in {c for _, _, c in brute.simhash(rows)}}
    assert simhash.keep_one(table.limit(0)).count() == 0


def test_keep_one_of_repeated_and_null_keys(spark):
    rng = random.Random(4)
    one, other, third = words(rng, 200, 5000), words(rng, 200, 5000), words(rng, 90, 5000)
    rows = [(4, one), (4, one), (4, other), (7, other), (None, one), (None, third), (None, third), (9, None), (8, " "), (None, "")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    for n in (1, 4):
        found = sorted(map(tuple, simhash.keep_one(table.repartition(n)).collect()), key=repr)
        assert found == sorted([(4, one), (4, other), (None, third), (8, " ")], key=repr)
    near = simhash.keep_one(spark.createDataFrame([(1, one), (1, one + " end"), (2, one)], "doc_id bigint, text string"))
    assert [r["doc_id"] for r in near.collect()] == [1]


def test_token_counts_come_from_the_cache(spark, rows, documents, none, tmp_path, monkeypatch):
    cache = f"file://{tmp_path}/cache"
    library = Tokenizer.from_file(PATH)
    want = sorted((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert sorted(map(tuple, token_counts.token_counts(documents, PATH, cache).collect())) == want
    n_texts = len({t or "" for _, t in rows})
    assert spark.read.parquet(cache).count() == n_texts
    more = documents.union(documents.withColumn("text", F.lit("new")).limit(2))
    assert token_counts.token_counts(more, PATH, cache).count() == len(rows) + 2
    assert spark.read.parquet(cache).count() == n_texts + 1
    assert token_counts.token_counts(none, PATH, cache).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_of_other_tokenizers(rows, documents, tmp_path, name):
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        count = lambda t: len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids)
    else:
        import sentencepiece

        count = lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t))
    found = token_counts.token_counts(documents, path, f"file://{tmp_path}/cache")
    few = {i: t for i, t in rows[:12]}
    got = {r["doc_id"]: r["n_tokens"] for r in found.collect()}
    assert {i: got[i] for i in few} == {i: count(t or "") for i, t in few.items()}


def test_ledger_policies_and_ablations(spark, documents, rows, none):
    ledger = quality.ledger(documents).persist()
    assert ledger.count() == len(rows) and quality.ledger(none).count() == 0
    by_id = {r["doc_id"]: r for r in ledger.collect()}
    texts = dict(rows)
    for i, t in texts.items():
        assert by_id[i]["n_words"] == len(brute.WORD.findall(t or ""))
        assert by_id[i]["word_chars"] == sum(map(len, brute.WORD.findall(t or "")))
    same = next(i for i, t in texts.items() if t == "same " * 60)
    assert by_id[same]["n_repeat_words"] == 60 and by_id[same]["failed_bits"] & 2
    for policy, names in quality.POLICIES.items():
        kept = {r["doc_id"] for r in ledger.where(quality.passes(policy)).collect()}
        found = [r for r in quality.ablations(ledger).collect() if r["policy"] == policy]
        assert {r["rule"] for r in found} == set(names) and {r["n_kept"] for r in found} == {len(kept)}
        for r in found:
            others = [n for n in names if n != r["rule"]]
            assert r["n_only"] == ledger.where(quality.passes(others)).count() - len(kept)
    assert {r["doc_id"] for r in quality.keep(documents).collect()} == {r["doc_id"] for r in ledger.where(quality.passes()).collect()}
    assert quality.keep(documents).columns == documents.columns


def pipeline_input(spark, rows, docs_schema=DOCUMENT):
    full = [(i, t, ["en", "fr", None][i % 3], "hot" if i % 3 else f"s{i % 4}", len(t or "")) for i, t in rows]
    return spark.createDataFrame(full, docs_schema)


def test_pipeline_stages(spark, rows, tmp_path):
    rng = random.Random(11)
    extra = [(1000 + i, words(rng, 60, 3000)) for i in range(60)]
    docs = pipeline_input(spark, rows + extra)
    assert [name for name, _ in corpus_pipeline.STAGES][:2] == ["quality_rules", "simhash_near_dedup"]
    kept, before = [], docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, "").write.parquet(f"file://{tmp_path}/{number}")
        after = spark.read.parquet(f"file://{tmp_path}/{number}")
        kept.append(({r["doc_id"]: r for r in before.collect()}, {r["doc_id"]: r for r in after.collect()}))
        before = after
    for a, b in kept[:-1]:
        assert set(b) <= set(a)
    rules, near, passages, mixed, encoded = kept
    assert set(rules[1]) == {r["doc_id"] for r in quality.ledger(docs).where(quality.passes()).collect()}
    assert {i for i in near[1] if i >= 1000} == {i for i in near[0] if i >= 1000}  # no clean one goes
    assert set(near[1]) == {c for _, _, c in brute.simhash([(i, r["text"]) for i, r in near[0].items()])}
    plain = brute.passages([(i, r["text"]) for i, r in passages[0].items()])
    assert {i: r["text"] for i, r in passages[1].items()} == {i: t for i, t in plain.items() if brute.WORD.search(t)}
    assert all(r["n_chars"] == len(r["text"]) for r in passages[1].values())
    assert 0 < len(mixed[1]) <= len(mixed[0])
    library = Tokenizer.from_file(PATH)
    for i, r in encoded[1].items():
        assert r["ids"] == library.encode(mixed[1][i]["text"], add_special_tokens=False).ids
        assert r["decoded_sha256"] == brute.sha(mixed[1][i]["text"])


def test_pipeline_of_nothing(spark, tmp_path):
    docs = pipeline_input(spark, [(1, "short"), (2, None)])
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "").write.parquet(f"file://{tmp_path}/{number}")
        docs = spark.read.parquet(f"file://{tmp_path}/{number}")
    assert docs.count() == 0
