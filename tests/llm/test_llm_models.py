"""Free-form operators: passages, token shards, trained models, the pipeline."""

import random

import duckdb
import numpy as np
import pytest

from stockpulse.llm import passages, quality, token_shards, toxicity
from stockpulse.llm.common import Stage, dense_index, documents
from stockpulse.llm.queries import QUERIES
from stockpulse.llm.sql import ORACLE

SF = "/root/testdata/sf0.001"
SF10 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def odd(spark):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    shared = [word() for _ in range(70)]
    fuzzy = [w if i % 15 else word() for i, w in enumerate(shared)]
    own = lambda n: [word() for _ in range(n)]
    texts = [" ".join(own(80) + shared + own(30)), " ".join(own(10) + shared), " ".join(fuzzy + own(200)),
             " ".join(own(150)), None, "", "few words only", " ".join(own(6)), " ".join(own(20) * 9)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(1, texts[1], 1), (None, " ".join(own(60)), 2), (None, None, 3)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, u long").repartition(3)


def test_passages_are_found_and_clean_rows_left_alone(odd, spark):
    rows, docs = odd
    got = passages.repeated_passages(docs).collect()
    assert len(got) == len(rows)
    flagged = {r["doc_id"] for r in got if r["n_passages"]}
    assert flagged == {0, 1, 2}
    for r in got:
        if r["doc_id"] in flagged:
            assert r["repeated_words"] >= 62 and set(r["partners"]) <= flagged - {r["doc_id"]}
    assert passages.repeated_passages(docs.where("false")).count() == 0


def test_passages_cover_shared_runs_of_given_documents(spark):
    docs = documents(spark, SF)
    words = {r["doc_id"]: (r["text"] or "").lower().split() for r in docs.collect()}
    held = {}
    for d, w in words.items():
        for i in range(len(w) - 50):
            held.setdefault(tuple(w[i:i + 51]), set()).add(d)
    need = {d for ds in held.values() if len(ds) > 1 for d in ds}
    found = {r["doc_id"] for r in passages.repeated_passages(docs).collect() if r["n_passages"]}
    assert need <= found and len(found) < len(words)


def test_chains_match_quadratic_dynamic_programming():
    rnd = random.Random(9)
    for _ in range(60):
        pairs = sorted({(rnd.randrange(40), rnd.randrange(40)) for _ in range(rnd.randint(1, 25))})
        xs, ys = [p for p, _ in pairs], [q for _, q in pairs]
        best = []
        for i, (x, y) in enumerate(pairs):
            best.append(6 + max([0, *(best[j] - 0.1 * (x - xs[j] + y - ys[j]) for j in range(i)
                                      if xs[j] < x and ys[j] < y)]))
        top = passages.chains(xs, ys, 6, 0.1, 1)[0]
        steps = sum(0.1 * (xs[b] - xs[a] + ys[b] - ys[a]) for a, b in zip(top, top[1:]))
        assert 6 * len(top) - steps == pytest.approx(max(best))
        assert all(xs[a] < xs[b] and ys[a] < ys[b] for a, b in zip(top, top[1:]))


def test_dissimilar_gaps_cut_a_chain(spark):
    rnd = random.Random(21)
    own = lambda n: ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    one, two, long = own(60), own(60), own(120)
    sides = [own(30) + one + own(70) + two + own(30) for _ in range(2)]  # two passages, unlike words between
    grown = [own(25) + long + own(25), own(25) + long[:60] + own(70) + long[60:] + own(25)]  # 70 words put in
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(sides + grown)], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in passages.repeated_passages(docs).collect()}
    for me, other in ((0, 1), (1, 0)):
        assert got[me] == f"30:90:{other},160:220:{other}"
    assert got[2] == "25:85:3,85:145:3" and got[3] == "25:85:2,155:215:2"


def test_a_passage_of_common_sentences_is_found_whole(spark):
    rnd = random.Random(22)
    own = lambda n: ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    stock = [own(30) for _ in range(8)]  # sentences that other documents hold too, alone
    texts = [own(40) + stock[0] + stock[1] + own(40), own(20) + stock[0] + stock[1] + own(20),
             own(35) + sum(stock[2:], []) + own(35), own(15) + sum(stock[2:], []) + own(15)]
    texts += [own(30) + s + own(30) for s in stock for _ in range(12)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in passages.repeated_passages(docs).collect()}
    assert [got[i]["spans"] for i in range(4)] == ["40:100:1", "20:80:0", "35:215:3", "15:195:2"]
    assert not any(got[i]["n_passages"] for i in range(4, len(texts)))


@pytest.mark.parametrize("every", [5, 6, 8, 10, 12])
def test_edited_passages_are_recalled(spark, every):
    """One word replaced in ``every``, at a random place of each group: identity 0.8 to 0.92."""
    rnd = random.Random(every)
    own = lambda n: ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    rows, n = [], 60
    for i in range(n):
        words = own(60 if i % 2 else 100)
        edited = list(words)
        for low in range(0, len(words), every):
            edited[min(low + (rnd.randrange(every) if every > 5 else 2), len(words) - 1)] = own(1)[0]
        rows += [(2 * i, " ".join(own(30) + words + own(30))), (2 * i + 1, " ".join(own(45) + edited + own(20)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["partners"] for r in passages.repeated_passages(docs).collect()}
    found = sum(i ^ 1 in got[i] for i in got) / len(got)
    assert found >= 0.95


def test_a_passage_is_found_however_many_others_hold_its_phrases(spark):
    """Documents 1 and 2 share an edited passage; each of its phrases also stands, alone, in
    documents of lower and of higher keys than theirs, which are the first and last holders."""
    rnd = random.Random(31)
    own = lambda n: ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    passage = own(80)
    edited = [own(1)[0] if i % 8 == 7 else w for i, w in enumerate(passage)]
    texts = {1: own(30) + passage + own(30), 2: own(20) + edited + own(20)}
    for i in range(10):  # phrase by phrase, in many documents each
        for n in range(12):
            texts[10 + 12 * i + n] = own(30) + passage[8 * i:8 * i + 7] + own(30)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r for r in passages.repeated_passages(docs).collect()}
    assert got[1]["partners"] == [2] and got[2]["partners"] == [1]
    assert got[1]["spans"] == "30:109:2" and got[2]["spans"] == "20:99:1"
    assert not any(got[i]["n_passages"] for i in texts if i > 9)


def test_every_holder_of_a_passage_is_a_partner(spark):
    rnd = random.Random(32)
    own = lambda n: ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    shared = own(60)
    texts = [" ".join(own(10 + i) + shared + own(20)) for i in range(6)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(10, texts[0]), (11, texts[0]), (11, texts[0]), (None, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in passages.repeated_passages(docs).collect()}
    every = set(range(6))
    for i in range(6):
        assert set(got[i]["partners"]) == every - {i} | ({10} if i == 0 else set())
        assert f"{10 + i}:{70 + i}:{(i + 1) % 6}" in got[i]["spans"].split(",")
    assert set(got[10]["partners"]) == set(got[11]["partners"]) == every
    assert "0:90:0" in got[11]["spans"].split(",") and got[11]["repeated_words"] == 90
    assert set(got[None]["partners"]) == every and "0:91:1" in got[None]["spans"].split(",")


def test_word_hashes_tell_words_apart():
    text = "One two\tone\n\x0b two  Three x  é"
    h = passages.word_hashes(text)
    words = text.lower().encode().split()
    assert len(h) == len(words)
    assert [words.index(w) for w in words] == [h.tolist().index(v) for v in h.tolist()]
    a, b = np.array([1, 2, 3, 4], dtype=np.uint64), np.array([1, 9, 3], dtype=np.uint64)
    assert passages.word_distance(a, b) == 2 and passages.word_distance(a, a[:0]) == 4


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    x = np.arange(n)
    y = token_shards.feistel(x, n, 5)
    assert sorted(y.tolist()) == x.tolist()
    assert token_shards.feistel(y, n, 5, inverse=True).tolist() == x.tolist()
    if n > 100:
        assert (token_shards.feistel(x, n, 6) != y).any() and (y != x).mean() > 0.9


def test_token_shards_round_trip(odd, spark, tmp_path):
    rows, docs = odd
    enc = token_shards.encoder(token_shards.vocabulary(spark, token_shards.VOCABULARY))
    with Stage(spark) as stage:
        shards, index = token_shards.materialise(docs, stage, length=32, per_shard=8, path=f"file://{tmp_path}/out")
        slots = {r["slot"]: np.frombuffer(bytes(r["ids"]), dtype="<u2") for r in shards.read(spark).collect()}
        assert sorted(slots) == list(range(shards.n_sequences))
        order = token_shards.feistel(np.arange(shards.n_sequences), shards.n_sequences, shards.key)
        stream = np.concatenate([slots[s][:-1] for s in order])
        assert all(len(v) == 32 and v[-1] == token_shards.END for v in slots.values())
        cuts = np.flatnonzero(stream == token_shards.END)
        texts = [enc.decode(p[p != token_shards.END].tolist()) for p in np.split(stream, cuts + 1)][:len(rows)]
        assert sorted(texts) == sorted(r[1] or "" for r in rows)
        later = shards.read(spark, 5, 11)
        assert {r["slot"]: bytes(r["ids"]) for r in later.collect()} == {
            s: v.tobytes() for s, v in slots.items() if 5 <= s <= 11}
        # a record stands where arithmetic says
        import glob
        for s, v in slots.items():
            file, = glob.glob(f"{tmp_path}/out/shard={s // 8}/part-*")
            with open(file, "rb") as f:
                f.seek(s % 8 * shards.stride)
                assert f.read(shards.stride) == v.tobytes()
        per = token_shards.sequence_index(shards, index).collect()
        assert sorted(r["slot"] for r in per) == sorted(slots)
        assert {d for r in per for d in r["doc_ids"]} == {r[0] for r in rows}


def test_token_shards_of_an_empty_table(odd, spark):
    with Stage(spark) as stage:
        assert token_shards.shard_report(odd[1].where("false"), stage).count() == 0


def _labelled(label):
    return duckdb.sql(f"SELECT text, {label} FROM '/root/testdata/sf0.1/documents.parquet' JOIN "
                      "'/root/testdata/sf0.1/labels.parquet' USING (doc_id) ORDER BY md5(doc_id::VARCHAR)").fetchall()


def test_line_crf_on_held_out_documents():
    rows = _labelled("quality")
    train, test = rows[:1500], rows[1500:]
    model = quality.fit_line_crf(train)
    seen = {0: [], 1: []}
    for text, y in test:
        got = quality.assess(text, model, 0.5)
        if not got[5]:
            seen[y].append(got[6])
    assert np.mean(seen[1]) > 0.99 and np.mean(seen[0]) < 0.05


def test_line_crf_labels_both_sides_of_a_cut():
    """Held-out texts spliced from good and junk pieces."""
    rows = _labelled("quality")
    model = quality.fit_line_crf(rows[:1500])
    assert model.moves[0][0] > model.moves[0][1] and model.moves[1][1] > model.moves[1][0]
    right, shares = {0: [], 1: []}, []
    for text, want in quality.spliced(rows[1500:], seed=5):
        lines, words = quality.split_lines(text)
        got = model.viterbi(quality.line_features(lines, quality.repeated_places(words)))
        assert len(got) == len(want)
        for a, b in zip(got, want):
            right[b].append(a == b)
        if set(want) == {0, 1}:
            shares.append(quality.assess(text, model, 0.5)[7])
    assert np.mean(right[1]) > 0.92 and np.mean(right[0]) > 0.85
    assert np.mean([0 < s < 1 for s in shares]) > 0.7


def test_toxicity_on_held_out_documents():
    rows = _labelled("toxic")
    train, test = rows[:3000], rows[3000:]
    model = toxicity.fit(train)
    caught = [toxicity.grade(t, model)[4] for t, y in test if y]
    alarms = [toxicity.grade(t, model)[4] for t, y in test if not y]
    assert np.mean(caught) > 0.85 and np.mean(alarms) < 0.02
    assert list(model.cuts) == sorted(model.cuts)
    p, _ = model.score("scum idiot")
    assert p == sorted(p, reverse=True)


def test_models_without_labels(odd, spark):
    rows, docs = odd
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    assert quality.train(docs, labels) is None and toxicity.train(docs, labels) is None
    assert {r["severity"] for r in toxicity.toxicity_report(docs, None).collect()} == {0.0}
    one = spark.createDataFrame([(0, 1, 0), (None, None, None)], "doc_id long, quality long, toxic long")
    assert quality.train(docs, one) is None and toxicity.train(docs, one) is None
    model = toxicity.fit([("you scum", 1)] * 9 + [("fine day", 0)] * 9)
    assert toxicity.toxicity_report(docs, model).count() == len(rows)
    assert toxicity.toxicity_report(docs.where("false"), model).count() == 0


def test_dense_index_is_gapless(spark):
    frame = spark.createDataFrame([(f"k{i % 50}", i) for i in range(500)], "k string, v long").repartition(7)
    got = dense_index(frame, ["k", "v"], "at").orderBy("at").collect()
    assert [r["at"] for r in got] == list(range(500))
    assert [(r["k"], r["v"]) for r in got] == sorted((r["k"], r["v"]) for r in got)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_agrees(spark, name):
    got = QUERIES[name](spark, SF10)
    names = sorted(got.columns)
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF10}/{table}.parquet'")
    want = con.sql(ORACLE[name]).project(", ".join(names)).fetchall()
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, want))


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    import corpus_pipeline as pipeline

    docs, counts = documents(spark, SF), []
    columns = docs.columns
    with Stage(spark) as stage:
        for name, function in pipeline.STAGES[:-1]:
            docs = stage.table(function(spark, docs, SF), name)
            counts.append(docs.count())
            assert docs.columns == columns
        last = pipeline.STAGES[-1][1](spark, docs, SF).collect()
        ids = {r["doc_id"] for r in docs.collect()}
    assert counts[0] >= counts[1] >= counts[2] > 0
    assert {d for r in last for d in r["doc_ids"]} == ids
    assert sorted(r["slot"] for r in last) == list(range(len(last)))
