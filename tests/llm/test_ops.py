"""The ten operators against brute force, on small frames with awkward rows and on sf0.01 tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pandas as pd
import pytest

from rillet.llm import lines, minhash, ordering, packing, pii, quality, sampling, toxicity, urls, vectors
from rillet.llm import queries as Q
from rillet.llm.common import components, held

SF = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, score string, kept string, component_id string, row string"
BASE = " ".join(f"word{i}" for i in range(60))


def docs(spark, rows):
    """doc_id and text, with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], DOC)


AWKWARD = [
    (1, BASE), (2, BASE), (3, BASE.upper() + " more"), (4, None), (5, ""), (6, " \n\t "), (7, "one two three"),
    (8, "One  TWO\nthree"), (9, "a\nb\nc\nd"), (10, "x\na\nb\nc\ny"), (11, "word " * 5000), (12, "Ünï ç☃ \U0001f600 x@y.de"),
    (None, "nobody's text goes here and stays"), (None, None), (13, "a\nb\nc\nd"), (13, "a\nb\nc\nd"),
]


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus(spark):
    return Q.documents(spark, SF).toPandas()


# -- 1 -----------------------------------------------------------------------------

def brute_links(rows):
    unit = {}
    for k, (_, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            a = np.array(v, float)
            if np.linalg.norm(a) > 0:
                unit[k] = a / np.linalg.norm(a)
    n, up = Counter(), {k: k for k in range(len(rows))}
    for i in unit:
        for j in unit:
            if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98:
                n[i] += 1
                n[j] += 1
                a, b = find(up, i), find(up, j)
                up[a] = b
    least = defaultdict(lambda: math.inf)
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(up, k)] = min(least[find(up, k)], r[0])
    return [(r[0], n[k], least[find(up, k)] if r[0] is not None else None) for k, r in enumerate(rows)]


def find(up, x):
    while up[x] != x:
        x = up[x]
    return x


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=16)], i % 3) for i in range(60)]
    hot = rng.normal(size=16)
    rows += [(100 + i, [float(x) for x in hot + rng.normal(size=16) * 0.03], 1) for i in range(80)]
    rows += [(200, [0.0] * 16, 1), (201, None, 1), (202, [None] * 16, 1), (203, [float("nan")] * 16, 1),
             (204, [float("inf")] + [0.0] * 15, 1), (205, [1.0, 0.0], 1), (206, [2.0, 0.0], 1), (207, rows[0][1], None),
             (208, [2 * x for x in rows[0][1]], 0), (209, list(rows[0][1]), 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, unit string")
    small = vectors.GraphOptions(shard_rows=20, block=32)       # several shards, several blocks of the hot one
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df, small).collect()}
    want = brute_links(rows)
    assert len(got) == len(rows)
    assert [(i, got[i]["component_id"]) for i, _, _ in want] == [(i, c) for i, _, c in want]
    found, exact = sum(got[i]["n_links"] for i, _, _ in want), sum(n for _, n, _ in want)
    assert all(got[i]["n_links"] <= n for i, n, _ in want) and found >= 0.9 * exact
    assert all(got[i]["kept"] == (c == i) for i, _, c in want)
    assert all(got[i]["audit_links"] == n for i, n, _ in want if i % 50 == 0 and got[i]["audit_links"] is not None)


def test_vectors_null_ids_and_empty_table(spark):
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)], schema)
    assert table(vectors.near_duplicates(df).select("vec_id", "component_id", "kept")) == [
        (1, 1, True), (1, 1, True), (None, None, False)]
    assert vectors.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_vectors_recall_on_table(spark):
    out = Q.op1_embedding_near_dedup(spark, SF).where("audit_links is not null").toPandas()
    assert len(out) and (out.n_links <= out.audit_links).all() and out.n_links.sum() >= 0.9 * out.audit_links.sum()


def test_range_search_finds_a_planted_group():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 32))
    x[:300] = x[0] + rng.normal(size=(300, 32)) * 0.02
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    options = vectors.GraphOptions()
    q, m = vectors.range_search(x, vectors.build_graph(x, options), x, options)
    want = (x @ x.T >= 0.98).sum()
    assert len(set(zip(q.tolist(), m.tolist()))) == len(q) and len(q) >= 0.99 * want


# -- 2 -----------------------------------------------------------------------------

def shingle_set(text):
    w = WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_groups(rows):
    """Component per row, rows of one id being one node."""
    sets = [shingle_set(t) for _, t in rows]
    seen = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            seen[x].append(k)
    common = Counter((a, b) for ks in seen.values() for i, a in enumerate(ks) for b in ks[i + 1:])
    up = {k: k for k in range(len(rows))}
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            up[find(up, a)] = find(up, b)
    for i in {r[0] for r in rows} - {None}:
        same = [k for k, r in enumerate(rows) if r[0] == i]
        for k in same[1:]:
            up[find(up, k)] = find(up, same[0])
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(up, k)] = min(least.get(find(up, k), r[0]), r[0])
    return [(r[0], len(sets[k]), least.get(find(up, k))) for k, r in enumerate(rows)]


def test_minhash_awkward_rows(spark):
    got = table(minhash.near_duplicates(docs(spark, AWKWARD)).select("doc_id", "n_shingles", "component_id"))
    assert got == sorted(brute_groups(AWKWARD), key=repr)
    assert minhash.near_duplicates(docs(spark, AWKWARD[:0]) if AWKWARD[:0] else
                                   spark.createDataFrame([], DOC)).count() == 0


def test_minhash_families_around_the_threshold(spark):
    """Chains and loose families: links that no star to the smallest id proves."""
    rng = np.random.default_rng(1)
    rows = []
    for f in range(6):
        words = [f"f{f}w{i}" for i in range(150)]
        for c in range(40):
            w = list(words)
            for at in rng.choice(150, int(rng.integers(0, 8)), replace=False):
                w[at] = f"f{f}c{c}e{at}"
            rows.append((int(rng.integers(1, 10 ** 9)), " ".join(w)))
    options = minhash.MinHashOptions(block=16)
    got = table(minhash.near_duplicates(docs(spark, rows), options).select("doc_id", "n_shingles", "component_id"))
    assert got == sorted(brute_groups(rows), key=repr)


def test_minhash_matches_brute_force_on_table(spark, corpus):
    got = Q.op2_minhash_near_dedup(spark, SF)
    want = brute_groups(list(zip(corpus.doc_id.tolist(), corpus.text)))
    assert table(got.select("doc_id", "n_shingles", "component_id")) == sorted(want, key=repr)
    assert got.where("kept <> (doc_id = component_id)").count() == 0


def test_densified_sketch_keeps_similarity():
    rng = np.random.default_rng(0)
    order = minhash.fill_order(300, 11)
    pool = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    a, b = np.unique(pool[:35]), np.unique(pool[5:])
    same = (minhash.sketch(a, 300, order) == minhash.sketch(b, 300, order)).mean()
    assert abs(same - 30 / 40) < 0.25
    assert (minhash.sketch(a[:1], 300, order) == minhash.sketch(a[:1], 300, order)[0]).all()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 180)] + [(1, k) for k in range(2, 40)] + [(7, 7), (None, 3), (500, 400)]
    got = dict(table(components(spark.createDataFrame(edges, "a long, b long"), "test")))
    assert all(got[i] == 100 for i in range(100, 181)) and all(got[k] == 1 for k in range(1, 40)) and got[500] == 400
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


# -- 3 -----------------------------------------------------------------------------

def brute_lines(rows):
    def solid(t):
        return [(i, x) for i, x in enumerate(t.split("\n")) if x.strip(" \t\n\x0b\x0c\r")]
    first = {}
    for i, t in rows:
        s = solid(t or "")
        for p in range(len(s) - 2):
            key, at = tuple(x for _, x in s[p:p + 3]), (lines.LAST if i is None else i, p)
            first[key] = min(first.get(key, at), at)
    out = []
    for i, t in rows:
        s, gone = solid(t or ""), set()
        for p in range(len(s) - 2):
            if first[tuple(x for _, x in s[p:p + 3])] != (lines.LAST if i is None else i, p):
                gone |= {k for k, _ in s[p:p + 3]}
        out.append((i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone), len(gone)))
    return out


def test_lines_awkward_rows(spark):
    rows = AWKWARD + [(20, "a\n\nb\n \nc\n\na\nb\nc\nq"), (None, "q\nr\ns"), (None, "p\nq\nr\ns"), (21, "same\n" * 50)]
    got = lines.dedup_lines(held(docs(spark, rows), "doc_id", "text"))
    assert set(got.select("row.*").columns) == {"doc_id", "score", "kept", "component_id", "row"}
    assert table(got.select("row.doc_id", "text", "n_removed")) == sorted(brute_lines(rows), key=repr)
    assert lines.dedup_lines(held(spark.createDataFrame([], DOC), "doc_id", "text")).count() == 0


# -- 4 -----------------------------------------------------------------------------

def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 5, 16, 17, 1000, 4097):
        assert sorted(ordering.feistel(np.arange(n), n, key=7).tolist()) == list(range(n))
    assert (ordering.feistel(np.arange(1000), 1000, 7) != ordering.feistel(np.arange(1000), 1000, 8)).any()


def test_training_order_round_trip(spark, tmp_path):
    options = ordering.OrderOptions(Q.tokenizer_path(), seq_len=16, shard_rows=8)
    source = docs(spark, AWKWARD)
    out = ordering.materialise(source, options)
    rows = out.toPandas()
    assert rows.slot.tolist() == list(range(len(rows))) and (rows.shard == rows.slot // 8).all()
    assert (rows.byte_offset == rows.slot % 8 * options.stride).all()
    manifest = ordering.write_shards(out, str(tmp_path / "shards"), options).toPandas()
    assert manifest.rows.sum() == len(rows) and len(list((tmp_path / "shards").glob("*.bin"))) == len(manifest)
    read = ordering.read_slots(str(tmp_path / "shards"), 0, len(rows), options)
    assert [read[k, :n].astype("<u2").tobytes() for k, n in enumerate(rows.n_tokens)] == rows.ids.tolist()
    assert all((read[k, n:] == options.pad_id).all() for k, n in enumerate(rows.n_tokens))
    assert (ordering.read_slots(str(tmp_path / "shards"), 5, 9, options) == read[5:14]).all()
    token = packing.WordTokenizer(options.tokenizer, 1000)
    want = Counter(len(token.encode(t)) // 4 + 1 for _, t in AWKWARD)
    whole = rows[rows.doc_id.notna() & (rows.doc_id != 13)].groupby("doc_id").n_tokens.sum()
    assert all(want[n] for n in whole)
    assert ordering.materialise(spark.createDataFrame([], DOC), options).count() == 0


# -- 5 -----------------------------------------------------------------------------

URLS = [None, "", "no scheme", "http://", "http://A.Example.NET/en/x?q#f", "https://x.net", "ftp://x.net/", "http://net/",
        "http://my-net/", "http://sub.example.com/de/1", "http://example.com/DE/1", "http://a.org/fr/", "http://a.org/fr",
        "http://casino-win.example.com/", "http://casinowin.example.com/", "http://a.com/free/bets", "http://a.com/FREE",
        "http://a.com/free-free", "http://a.com/xxx?porn", "http://a.com/?xxx", "http://xxxl.com/", "a://b://c/xxx", "http://é.com/sexé",
        "http://a.com/?q=porn", "www.porn.com/xxx", "//porn.com/", "http://a.com/p%6Frn#x", "http://a.com/p%256frn", "http://a.com/%%70orn",
        "http://a.com/?q=poker", "http://a.com/poker?free=1", "http://a.com/gratis#win", "http://a.com/CASINO&KREDIT", "http://a.net/poker?porn",
        "http://a.com/" + "x/" * 200_000 + "porn", "http://a.com/100%", "http://a.com/%zz%"]


def test_urls(spark):
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(URLS)] + [(None, URLS[4], "h", "p")],
                               "page_id long, url string, host string, path string")
    got = {r["page_id"]: r for r in urls.judge_urls(df).collect()}
    assert (got[4]["host"], got[4]["path"], got[4]["rule"], got[4]["verdict"]) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert [got[i]["verdict"] for i in range(len(URLS))] == [
        "allow", "allow", "allow", "allow", "allow", "allow", "block", "block", "allow", "block", "allow", "allow", "allow",
        "block", "allow", "block", "allow", "allow", "block", "block", "allow", "block", "allow",
        "block", "block", "block", "block", "allow", "block", "allow", "block", "allow", "block", "block", "block", "allow", "allow"]
    assert (got[32]["n_strict"], got[32]["soft_weight"], got[32]["terms"]) == (0, 4, "casino,kredit")
    assert (got[24]["host"], got[24]["path"], got[24]["n_strict"]) == ("", "", 2)
    assert (got[0]["host"], got[0]["path"], got[0]["rule"]) == ("", "", None) and len(got) == len(URLS) + 1
    duck = pytest.importorskip("duckdb").connect()
    duck.register("pages", pd.DataFrame({"page_id": range(len(URLS)), "url": URLS}))
    want = duck.execute(urls.oracle()).df()
    cols = list(want.columns)
    assert sorted(map(str, want.astype(object).where(want.notna(), None).values.tolist())) == sorted(
        str([r[c] for c in cols]) for i, r in got.items() if i is not None)
    assert urls.judge_urls(df.limit(0)).count() == 0
    table = spark.createDataFrame([("Bad", None), ("meh", 2), ("so", 1), ("meh", 2), (None, 1)], "term string, weight int")
    own = urls.load_vocabulary(table, rules=(), limit=3)
    judge = urls.UrlJudge(own).judge
    assert [judge(u)[3] for u in ("x.bad", "x/meh", "x/meh?so", "x/so?so", "xbad")] == ["block", "allow", "block", "allow", "allow"]


# -- 6 -----------------------------------------------------------------------------

def brute_measures(t):
    w = WORDS.findall(t or "")
    runs = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    n = Counter(runs)
    again = {p for k, r in enumerate(runs) if n[r] > 1 for p in range(k, k + 5)}
    full = [x for x in (t or "").split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(full) - len(set(full)), len(again)


def test_quality_measures(spark, corpus):
    model = quality.QualityModel(None, 1.0, 0.0, quality.QualityOptions())
    rows = AWKWARD + [(30, "a b c d e " * 3 + "#*| <>$%& \n\n x\n x\nx"), (31, "\x0b\x0c\x1c y\x85z")]
    got = table(quality.judge(docs(spark, rows), model).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))
    want = []
    for i, t in rows:
        m = brute_measures(t)
        failed = m[0] < 10 or 100 * m[4] > 20 * m[0]
        want.append((i, *m, failed, not failed))
    assert got == sorted(want, key=repr)
    for t in corpus.text[:200]:
        assert quality.measures(np.frombuffer(t.encode(), np.uint8)) == brute_measures(t)


def test_quality_classifier(spark):
    out = Q.op6_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").selectExpr("doc_id", "quality good"), "doc_id")
    p = out.where("not base_failed").toPandas()
    assert ((p.quality >= 0.5) == (p.good == 1)).mean() > 0.9
    assert p[p.good == 1].kept.mean() > 0.97
    assert out.where("base_failed and kept").count() == 0
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(docs(spark, AWKWARD), empty).weights is None


# -- 7 -----------------------------------------------------------------------------

def brute_pii(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m.group())
        if 14 <= len(d) <= 19 and sum(sum(map(int, str(int(c) * (1 + k % 2)))) for k, c in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub(r"\D", "", m.group())) <= 15]
    return sorted(out)


def test_pii_base_spans_match_the_patterns(corpus):
    rng = np.random.default_rng(2)
    alphabet = list("ab1290.@-+ ()%_\n") + ["4111111111111111", "é", "1.2.3.4"]
    made = ["".join(rng.choice(alphabet, 60)) for _ in range(3000)]
    for t in [*made, *corpus.text, "a@b.co_x@y.com", "x@-.-", "a@b..c", "0004.0.0.0255 1.2.3.4.5.6.7.8",
              "0" * 3000 + "1.2.3.4"]:
        assert pii.base_spans(t) == brute_pii(t), t


@pytest.mark.parametrize("text, kind, span", [
    ("write to john (at) example [dot] org now", "email", "john (at) example [dot] org"),
    ("john dot doe at example dot com!", "email", "john dot doe at example dot com"),
    ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"), ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("call plus four nine one five two three four five six seven eight nine", "phone",
     "plus four nine one five two three four five six seven eight nine"),
    ("card four one one one 1111 1111 one one one one", "card", "four one one one 1111 1111 one one one one"),
    ("ip one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
    ("+4 9​15 2345 67890", "phone", "+4 9​15 2345 67890"),
])
def test_pii_disguises_map_back(text, kind, span):
    assert (kind, span) in [(pii.KINDS[k], text[s:e]) for s, k, e in pii.all_spans(text)]


def test_pii_rows(spark):
    rows = AWKWARD + [(40, "look at example.com, seven of nine at dot"), (41, "a@b.de 1.2.3.4 a@b.de")]
    got = {r["doc_id"]: r for r in pii.find_pii(docs(spark, rows)).collect()}
    assert got[4]["base_sha256"] == hashlib.sha256(b"").hexdigest() and got[40]["spans"] == ""
    assert (got[41]["n_email"], got[41]["n_ip"], got[41]["spans"]) == (2, 1, "email:0:6,ip:7:14,email:15:21")
    assert pii.redact_text("a@b.de, 1.2.3.4!") == "<email>, <ip>!"
    assert pii.find_pii(spark.createDataFrame([], DOC)).count() == 0


# -- 8 -----------------------------------------------------------------------------

def test_tokenizer_equals_whole_text_encoding(corpus):
    from tokenizers import Tokenizer
    path = Q.tokenizer_path()
    whole = Tokenizer.from_file(path)
    odd = ["a <|endoftext|> b", "x<|startoftext|>Y.<|endoftext|>", "<|EndOfText|> <|endoftext", "É É'S don't DON'T I'll. 12,5 ΣΑΣ ΑΣ, é İstanbul a\xa0b  x <|endoftext|> ok.., 中文. ½ x² ǅ ﬁ. ß ẞ  \t\x1cq a,b '.,", "", "\n"]
    ours = packing.WordTokenizer(path, 500)
    for t in [*odd, *corpus.text[:300]]:
        assert ours.encode(t) == np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_plan_uses_every_piece_once_and_fits():
    rng = np.random.default_rng(4)
    for n, capacity in ((1, 8), (40, 8), (3000, 64), (20000, 2048)):
        counts = Counter(int(min(capacity, 1 + rng.lognormal(math.log(capacity) - 2, 1))) for _ in range(n))
        patterns = packing.plan(dict(counts), capacity)
        used = Counter()
        for lengths, copies in patterns:
            assert sum(lengths) <= capacity and copies > 0
            for x in lengths:
                used[x] += copies
        assert used == counts
        assert sum(c for _, c in patterns) <= 1.02 * -(-sum(x * c for x, c in counts.items()) // capacity) + 1
    assert packing.plan({}, 8) == []


@pytest.mark.parametrize("whole", [False, True])
def test_packing_layout(spark, corpus, whole):
    rows = list(zip(corpus.doc_id.tolist(), corpus.text)) if whole else AWKWARD
    source = Q.documents(spark, SF) if whole else docs(spark, rows)
    options = packing.PackingOptions(Q.tokenizer_path(), capacity=2048 if whole else 32, bucket_rows=50)
    got = packing.pack(source, options).toPandas()
    token, want = packing.WordTokenizer(options.tokenizer, 10 ** 6), []
    for i, t in rows:
        ids = token.encode(t) + bytes(4)
        for k, at in enumerate(range(0, len(ids), 4 * options.capacity)):
            part = ids[at:at + 4 * options.capacity]
            want.append((i, k, at // 4, len(part) // 4, zlib.crc32(part)))
    have = [(None if pd.isna(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    got = got.sort_values(["sequence_id", "offset"])
    by = got.groupby("sequence_id").length
    assert (got.offset == by.cumsum() - got.length).all() and by.sum().max() <= options.capacity


def test_packing_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], DOC), packing.PackingOptions(Q.tokenizer_path())).count() == 0


# -- 9 -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def sampler():
    return sampling.Sampler(sampling.SamplingOptions(Q.tokenizer_path("piece_bpe_32k.model"), k=3, alpha=0.1))


def all_segmentations(lattice, i=0):
    if i == len(lattice.ends):
        yield (), 0.0
        return
    for end, codes, log in zip(lattice.ends[i], lattice.ids[i], lattice.logs[i]):
        for rest, more in all_segmentations(lattice, end):
            yield codes + rest, log + more


def test_samples_follow_the_lattice_without_replacement(sampler):
    text = "then x"
    units = sampler.units(text)
    exact = {(): 0.0}
    for u in units:
        exact = {a + b: x + y for a, x in exact.items() for b, y in all_segmentations(sampler.lattice(u))}
    p = {k: math.exp(v) for k, v in exact.items()}
    assert abs(sum(p.values()) - 1) < 1e-9 and len(p) > 6
    n, first, drawn, score = 6000, Counter(), Counter(), Counter()
    for seed in range(n):
        out = sampler.sample(text, seed)
        assert len({tuple(x[0]) for x in out}) == len(out) == 3
        assert all(a[2] >= b[2] for a, b in zip(out, out[1:]))
        first[tuple(out[0][0])] += 1
        for ids, log, _, inclusion in out:
            assert abs(exact[tuple(ids)] - log) < 1e-9 and 0 < inclusion <= 1
            drawn[tuple(ids)] += 1
            score[tuple(ids)] += 1 / inclusion
    inclusion = Counter()
    for a, b, c in permutations(p, 3):
        q = p[a] * p[b] / (1 - p[a]) * p[c] / (1 - p[a] - p[b])
        for k in (a, b, c):
            inclusion[k] += q
    for k in p:
        assert abs(first[k] / n - p[k]) < 0.03 and abs(drawn[k] / n - inclusion[k]) < 0.03
    # the inclusion scores make unbiased sums: every segmentation counts once on average
    assert abs(sum(score.values()) / n - len(p)) < 0.15 * len(p)


def test_samples_decode_and_repeat(spark, sampler):
    rows = [(1, 1, "Hello wörld ☃ \U0001f600  x\n y"), (1, 2, ""), (2, None, None), (None, 3, "a"), (3, 3, "word " * 500)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, text string, sample int")
    options = sampling.SamplingOptions(Q.tokenizer_path("piece_bpe_32k.model"), k=3, alpha=0.2)
    one = table(sampling.sample_segmentations(df, ["conv_id", "turn"], options))
    assert one == table(sampling.sample_segmentations(df.repartition(3), ["conv_id", "turn"], options))
    text = {r[:2]: r[2] for r in rows}
    per = Counter(r[:2] for r in one)
    assert per[(1, 1)] == per[(3, 3)] == 3 and per[(1, 2)] == per[(2, None)] == 1
    for conv, turn, _, ids, *_ in one:
        assert sampler.decode(ids) == sampler.decode(sampler.encode(text[(conv, turn)]))
    assert sampling.sample_segmentations(df.limit(0), ["conv_id", "turn"], options).count() == 0


def test_encode_and_decode_frames(spark, sampler):
    """Every turn's ids are the model's, and decode to its normalised text; samples of a turn decode alike."""
    options = sampling.SamplingOptions(Q.tokenizer_path("piece_bpe_32k.model"), k=2)
    keys = ["conv_id", "turn"]
    turns = spark.read.parquet(f"{SF}/conversations.parquet").select(*keys, "text")
    turns = turns.union(spark.createDataFrame([(-1, 0, None), (-2, 0, ""), (None, None, "Zwei  Wörter ☃")], turns.schema))
    encoded = sampling.encode_texts(turns, keys, options).cache()
    source = {(r.conv_id, r.turn): r.text for r in turns.collect()}
    got = {(r.conv_id, r.turn): r.ids for r in encoded.collect()}
    assert got == {k: sampler.encode(t) for k, t in source.items()}
    back = {(r.conv_id, r.turn): r.text for r in sampling.decode_ids(encoded, keys, options).collect()}
    assert back == {k: sampler.decode(ids) for k, ids in got.items()} and back[(-1, 0)] == back[(-2, 0)] == ""
    assert back[(None, None)] == source[(None, None)]           # this vocabulary keeps double spaces
    drawn = sampling.sample_segmentations(turns.where("conv_id < 20"), keys, options)
    for r in sampling.decode_ids(drawn, keys, options).collect():
        assert r.text == back[(r.conv_id, r.turn)]
    none = spark.createDataFrame([(1, 1, None), (2, 1, [])], "conv_id long, turn long, ids array<int>")
    assert {r.text for r in sampling.decode_ids(none, keys, options).collect()} == {""}


# -- 10 ----------------------------------------------------------------------------

def test_grams_stay_inside_words():
    gram, word = toxicity.text_grams(np.frombuffer(b"Ab, c", np.uint8), 3)
    spelled = [int(g & toxicity._LOW).to_bytes(int(g >> np.uint64(toxicity._TAG)), "big") for g in gram]
    assert spelled == [b" a", b" ab", b"ab ", b" c", b" c "] and word.tolist() == [0, 0, 0, 1, 1]
    assert len(toxicity.text_grams(np.zeros(0, np.uint8), 3)[0]) == 0


def test_ratios_match_the_formula(spark):
    """The Spark aggregation against the Kneser-Ney formula, counted by hand."""
    options = toxicity.ToxicityOptions(order=3, discount=0.5)
    texts = {0: "abab cab abc", 1: "abd abd bad"}
    n = {c: Counter(toxicity.text_grams(np.frombuffer(t.encode(), np.uint8), 3)[0].tolist()) for c, t in texts.items()}
    rows = [(g, n[0][g], n[1][g]) for g in set(n[0]) | set(n[1])]
    found = toxicity._ratio_rows(spark.createDataFrame(rows, "gram long, n0 long, n1 long"), options).collect()
    held_codes = ratio_look_up(found)
    spell = {g: int(g & int(toxicity._LOW)).to_bytes(g >> toxicity._TAG, "big") for g, *_ in rows}
    for code, g in spell.items():
        same = [x for x in spell.values() if len(x) == len(g) and x[1:-1] == g[1:-1]]
        cont, total = sum(x[1:] == g[1:] for x in same), len(same)
        shared = (max(cont - 0.5, 0) + 0.5 * len({x[1:] for x in same}) / 256) / total
        p = []
        for c in (0, 1):
            of = {spell[k]: v for k, v in n[c].items()}
            ctx = {x: v for x, v in of.items() if len(x) == len(g) and x[:-1] == g[:-1]}
            t = sum(ctx.values())
            p.append(max(of.get(g, 0) - 0.5, 0) / max(t, 1) + (min(1, 0.5 * len(ctx) / t) if t else 1) * shared)
        assert abs(held_codes(code) - math.log(p[1] / p[0])) < 1e-5


def ratio_look_up(rows):
    """A gram's log-ratio from stored rows: its own entry and its context's."""
    table = toxicity.ratio_table(np.array([r["code"] for r in rows], np.int64), np.array([r["value"] for r in rows]))

    def ratio(gram):
        g = np.array([gram], np.uint64)
        return float((toxicity.find(table, g) + toxicity.find(table, toxicity.context_of(g) | toxicity._CONTEXT))[0])
    return ratio


def test_ratio_table_finds_exactly_its_codes():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 5000):
        codes = np.unique(rng.integers(0, 1 << 62, n))
        values = rng.normal(size=len(codes))
        table = toxicity.ratio_table(codes, values)
        asked = np.concatenate((codes, rng.integers(0, 1 << 62, 1000)))
        held_by = dict(zip(codes.tolist(), values.astype(np.float32).tolist()))
        assert toxicity.find(table, asked.astype(np.uint64)).tolist() == [held_by.get(c, 0.0) for c in asked.tolist()]


def test_toxicity_in_slices(spark):
    """A table scored in several passes gives the scores of one pass, extra columns kept."""
    source = docs(spark, [(i, f"plain words number {i} here") for i in range(60)]
                  + [(100 + i, f"vile scum number {i}") for i in range(60)] + AWKWARD)
    marks = spark.createDataFrame([(i, 0) for i in range(60)] + [(100 + i, 1) for i in range(60)], "doc_id long, toxic int")
    source = source.withColumnRenamed("kept", "evidence").drop("score")
    whole = toxicity.train(source, marks)
    sliced = toxicity.train(source, marks, toxicity.ToxicityOptions(slice_rows=60))
    assert whole.ratios.slices == 1 and sliced.ratios.slices > 2
    one, many = (sorted(toxicity.score(source, m).collect(), key=repr) for m in (whole, sliced))
    assert one[0].asDict().keys() == many[0].asDict().keys()
    assert [r[:-1] for r in one] == [r[:-1] for r in many]
    assert np.allclose([r["score"] for r in one], [r["score"] for r in many], atol=1e-4)


def test_toxicity_held_out(spark):
    out = Q.op10_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    p = out.join(labels, "doc_id").where("held_out").toPandas()
    assert (p.predicted == p.toxic).mean() > 0.96 and p[p.toxic == 0].predicted.mean() < 0.02
    assert out.where("score < 0 or score > 1 or predicted <> cast(score >= 0.5 as int)").count() == 0


def test_toxicity_awkward_rows(spark):
    rows = [(i, f"plain words number {i} here") for i in range(60)] + [(100 + i, f"vile scum number {i}") for i in range(60)]
    source = docs(spark, rows + AWKWARD)
    marks = [(i, 0) for i in range(60)] + [(100 + i, 1) for i in range(60)] + [(100, 0), (None, 1), (3, None), (9999, 1)]
    model = toxicity.train(source, spark.createDataFrame(marks, "doc_id long, toxic int"))
    scored = toxicity.score(source.drop("score"), model)
    got = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert scored.count() == len(rows) + len(AWKWARD) and min(got[100 + i] for i in range(60)) > 0.5 > max(got[i] for i in range(14, 60))
    none = toxicity.train(source, spark.createDataFrame([], "doc_id long, toxic int"))
    assert none.weights is None and {r["score"] for r in toxicity.score(source.drop("score"), none).collect()} == {0.0}
    assert toxicity.score(spark.createDataFrame([], DOC).drop("score"), model).count() == 0


def test_pii_number_of_any_length():
    zeros = "0" * 6000
    assert [s[1] for s in pii.base_spans(f"{zeros}1.2.3.{zeros}4 1.2.3.{zeros}999")] == [1]
