"""Personal data, ranked search and spelling variants against brute force on small tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from stockpulse.llm import ranked_search, sanitise, spelling
from stockpulse.llm.common import documents
from stockpulse.llm.queries import QUERIES

# columns named like the operators' own travel along or are left out
SCHEMA = ("doc_id long, text string, row long, term string, n long, id long, block int, word string, key string, "
          "spans string, tags map<string,int>")
EXTRA = (7, "clash", 1, 2, 3, "clash", "clash", "clash", {"a": 1})


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def table(spark, texts):
    return spark.createDataFrame([(i, t, *EXTRA) for i, t in texts], SCHEMA).repartition(3)


def words(rnd, n, letters="abcdé", least=4):
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(least, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    vocab = words(rnd, 400) + ["ÀÖþ÷×ab", "Straße", "aaaaa", "aaaaaa", "aaaba", "aaaaab", "ABcde", "abcde"]
    rows = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 60))) + rnd.choice(["", ".", "\n\x85_x"]))
            for i in range(120)]
    rows += [(1, rows[1][1]), (1, rows[1][1]), (None, rows[2][1]), (None, None), (500, ""), (501, None), (502, " \n.,"),
             (503, "z" * 30_000 + " " + "ab cde " * 5_000), (504, "漢字 ǅungla İstanbul x́ ab12 AB12 a_b"), *[(505 + k, "y" * 3_000) for k in range(3)],
             (600, "kkkkk " * 3 + "kkkkm " * 8 + "kkkmm " * 20 + "kkmmm " * 50)]
    return rows


# ---- ranked search

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(rows, items, top=10):
    docs = [(i, collections.Counter(TERMS.findall(lower(t or "")))) for i, t in rows]
    n_all = sum(1 for _, c in docs if c)
    l_all = sum(sum(c.values()) for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in docs:
            m = 10 + 90 * sum(c.values()) * n_all // l_all if l_all else 10
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(TERMS.findall(lower(text or ""))) if c[t])
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:top], 1)]
    return out


ITEMS = [(0, "abcde AAAAA straße"), (1, None), (2, ""), (3, "notheld"), (4, "x ab12 a b ab cde"), (4, "x ab12 a b ab cde"),
         (None, "漢字 y"), (6, "abcde " * 50 + "aaaba aaaaab")]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


@pytest.mark.parametrize("sizes", [{}, {"owners": 7, "block_docs": 5, "bundle_items": 2}, {"owners": 1, "block_postings": 30}])
def test_search_is_brute_force(spark, rows, sizes):
    items = spark.createDataFrame([(i, t, 9, "clash") for i, t in ITEMS], "item_id long, text string, item_no int, term string")
    found = ranked_search.ranked_search(table(spark, rows), items, **sizes).collect()
    assert order(map(tuple, found)) == order(brute_search(rows, ITEMS))


def test_search_of_empty_tables(spark, rows):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for docs, asked in ((table(spark, []), items), (table(spark, rows[:9]), items.limit(0)), (table(spark, [(1, None)]), items)):
        assert ranked_search.ranked_search(docs, asked).collect() == []


def test_scores_pack_and_unpack():
    rnd = random.Random(3)
    import numpy as np
    for n in (1, 7, 4096):
        scores = np.array([rnd.choice([0, 0, rnd.randrange(1 << 40)]) for _ in range(n)], np.int64)
        assert (ranked_search.unpack_scores(ranked_search.pack_scores(scores), n) == scores).all()


# ---- spelling variants


def brute_counts(rows, every=97):
    c = collections.Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(w)
            h = zlib.crc32(f"{'null' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            c[w] += 1
    return c


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows, every=97):
    vocab = {w: n for w, n in brute_counts(rows, every).items() if len(w) >= 5 and n >= 3}
    forms, many = {}, {}
    for w, n in vocab.items():
        beside = [x for x in vocab if near(w, x)]
        best = min(beside, key=lambda x: (-vocab[x], x), default=None)
        forms[w], many[w] = best if best and vocab[best] >= 2 * n else None, len(beside)

    def root(w):
        while forms[w]:
            w = forms[w]
        return w
    return {(w, forms[w], root(w), n, many[w], vocab.get(forms[w])) for w, n in vocab.items()}


@pytest.mark.parametrize("every", [97, 3])
def test_variants_are_brute_force(spark, rows, every):
    found = spelling.spelling_variants(table(spark, rows), every=every).collect()
    expected = brute_variants(rows, every)
    assert len(found) == len(expected) and set(map(tuple, found)) == expected
    assert any(r.form for r in found) and (every == 3 or ("kkkkk", "kkmmm") in {(r.word, r.root) for r in found})


def test_variants_hold_on_many_partitions(spark):
    """Nodes that reach over partition edges, and one head letter sequence that all words share."""
    rnd = random.Random(2)
    texts = [(i, " ".join("prefixe" + w for w in words(rnd, 40, "ab", 0))) for i in range(60)]
    expected = brute_variants(texts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        found = spelling.spelling_variants(table(spark, texts)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(map(tuple, found)) == expected


def test_trie_numbers_are_one_per_prefix():
    rnd = random.Random(8)
    all_words = sorted(set(words(rnd, 300, "abc", 1)))
    cuts = [0, 1, 40, 41, 120, len(all_words)]
    parts = [all_words[a:b] for a, b in zip(cuts, cuts[1:])]
    paths = spelling.paths_of([p[0] for p in parts])
    heads = [(p[0], path) for p, path in zip(parts, paths)] + [("", [0])]
    numbers = {}
    for i, part in enumerate(parts):
        scan = spelling.NodeScan(i, *heads[i], *heads[i + 1])
        for word in part:
            path = scan(word)
            assert len(path) == len(word) + 1
            for d, node in enumerate(path):
                assert numbers.setdefault(word[:d], node) == node
    assert len(set(numbers.values())) == len(numbers)


def test_variants_of_empty_tables(spark):
    assert spelling.spelling_variants(table(spark, [])).collect() == []
    assert spelling.spelling_variants(table(spark, [(1, None), (None, "")])).collect() == []


# ---- personal data

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(d):
    total = 0
    for i, ch in enumerate(reversed(d)):
        x = int(ch) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute_base(text):
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_spans_on_random_texts():
    rnd = random.Random(4)
    pieces = ["a", "B.c", "@", "x@y", ".", "-", " ", "1", "23", "256", "1.2.3.4", "+", "(0", ")", "4111 1111 1111 1111",
              "é", "\n", "%", "0.0.0.0007", "+1 (017) 555-7713", "a@b.c", "..", "_", "٣"]
    for _ in range(4000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25)))
        assert [(sanitise.KINDS[k], a, b) for k, a, b, _ in sanitise.entity_spans(text)] == brute_base(text), text


def test_base_spans_on_long_runs_take_linear_time():
    text = "a" * 300_000 + " " + "1" * 300_000 + " " + "+1" + "." * 300_000 + " " + "a@b" * 50_000 + " x@y.zz"
    assert [(sanitise.KINDS[k], text[a:b]) for k, a, b, _ in sanitise.entity_spans(text)] == [("email", "x@y.zz")]


def secret_rows():
    rnd = random.Random(6)
    common = words(rnd, 60, "mnopq")
    say = lambda n: " ".join(rnd.choice(common) for _ in range(n))
    rows = []
    for i in range(40):  # "Waldemar" and "Quistgata7" stand beside one address only
        mail = "w.q@mail.example" if i % 8 == 0 else f"u{i}@mail{i}.example"
        rows.append((i, f"{say(30)} {'Waldemar Quistgata7' if i % 8 == 0 else say(2)} {mail} {say(30)} "
                        f"{'waldemar' if i == 8 else ''}"))
    rows += [(100 + i, say(50)) for i in range(30)]
    rows += [(200 + i, "Quistling " + say(20)) for i in range(6)]  # more words that begin with "quis"
    rows += [(300, "Solitaer 10.0.0.1 " + say(9))] * 5  # copies of one text are no evidence
    rows += [(None, None), (400, ""), (401, "Waldemar " + say(5))]
    return rows


def brute_disclosures(rows, window=10, disclosure=0.9, min_texts=3, stem=4):
    total = len(rows)
    in_docs, df_e = collections.defaultdict(set), collections.Counter()
    near, texts = collections.Counter(), collections.defaultdict(set)
    docs = []
    for at, (_, text) in enumerate(rows):
        text = text or ""
        base = brute_base(text)
        ents = {(k, text[a:b].lower() if k == "email" else text[a:b] if k == "ip" else re.sub("[^0-9]", "", text[a:b])): [] for k, a, b in base}
        for k, a, b in base:
            ents[k, text[a:b].lower() if k == "email" else text[a:b] if k == "ip" else re.sub("[^0-9]", "", text[a:b])].append((a, b))
        terms = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W_]{3,}", text)]
        for _, _, t in terms:
            in_docs[t].add(at)
            in_docs[t[:stem] + "*"].add(at)
        clear = [x for x in terms if not any(x[0] < b and a < x[1] for _, a, b in base)]
        for e, spans in ents.items():
            df_e[e] += 1
            seen = set()
            for a, b in spans:
                seen |= {t for _, _, t in [x for x in clear if x[0] < a][-window:] + [x for x in clear if x[0] >= b][:window]}
            for t in seen | {t[:stem] + "*" for t in seen}:
                near[e, t] += 1
                texts[e, t].add(text)
        docs.append((base, ents, clear))

    def tells(e, t):
        ic = math.log2(total / df_e[e])
        return (len(texts[e, t]) >= min_texts and ic > 0
                and math.log2(near[e, t] * total / (df_e[e] * len(in_docs[t]))) / ic >= disclosure)
    out = []
    for (doc, _), (base, ents, clear) in zip(rows, docs):
        more = []
        for a, b, t in clear:
            told = [e for e in ents if tells(e, t)]
            if told:
                more.append(("remove" if any(tells(e, t[:stem] + "*") for e in told) else "general", a, b))
        out.append((doc, joined(base), joined(base + sorted(more))))
    return out


def test_disclosures_are_brute_force(spark):
    rows = secret_rows()
    for threshold in (0.9, 0.5):
        found = sanitise.scan_disclosures(table(spark, rows), disclosure=threshold).collect()
        expected = brute_disclosures(rows, disclosure=threshold)
        assert order((r.doc_id, r.base_spans, r.spans) for r in found) == order(expected)
        for r in found:
            kinds = collections.Counter(s.split(":")[0] for s in r.base_spans.split(","))
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in ("email", "ip", "card", "phone"))
            assert bool(r.base_spans) or not r.spans  # documents without an entity stay as they are
        if threshold == 0.9:
            assert any("general:" in r.spans for r in found) and any("remove:" in r.spans for r in found)


def test_sanitised_texts(spark):
    rows = secret_rows()
    docs = table(spark, rows)
    clean = sanitise.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[None] is None and texts[401] == dict(rows)[401] and texts[100] == dict(rows)[100]
    assert "Quis* <email>" in texts[0] and "Waldemar" not in texts[0] and "waldemar" not in texts[8]
    assert texts[300].startswith("Solitaer <ip> ")
    again = sanitise.scan_disclosures(clean).agg(F.sum("n_email"), F.sum("n_ip")).first()
    assert tuple(again) == (0, 0)


def test_disclosures_of_empty_tables(spark):
    assert sanitise.scan_disclosures(table(spark, [])).collect() == []
    assert sanitise.sanitise(table(spark, [])).collect() == []
    only = sanitise.scan_disclosures(table(spark, [(None, None), (3, "")])).collect()
    assert order((r.doc_id, r.base_spans, r.spans) for r in only) == [(None, "", ""), (3, "", "")]


def test_registered_queries_on_the_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in documents(spark, sf).select("doc_id", "text").collect()]
    items = [tuple(r) for r in documents(spark, sf, "benchmark").select("item_id", "text").collect()]
    pii = {r.doc_id: r for r in QUERIES["op11_pii_disclosure"](spark, sf).collect()}
    for doc, _, spans in brute_disclosures(rows):
        base = joined(brute_base(dict(rows)[doc]))
        assert pii[doc].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and pii[doc].spans == spans
    assert len(pii) == len(rows) and any(r.spans for r in pii.values())
    found = QUERIES["op12_ranked_search"](spark, sf).collect()
    assert order((r.item_id, r.rank, r.doc_id, r.score) for r in found) == order(brute_search(rows, items))
    variants = QUERIES["op13_spelling_variants"](spark, sf).collect()
    expected = brute_variants(rows)
    assert set(map(tuple, variants)) == expected and len(variants) == len(expected)
