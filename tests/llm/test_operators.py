"""Small fixtures held against brute-force versions and exact round trips."""

import collections
import hashlib
import random
import re
import unicodedata
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from paylake.llm import (chat_bytes, components, dartminhash, decontaminate, exact_dedup, ga_packing, pii_crf, queries,
                         substring, text_cnn, url_redirects, warc_index)

SMOKE = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, row string, lang string, source string, n_chars bigint"


def prose(seed, n, words=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edit(text, every, seed):
    rng = random.Random(seed)
    return " ".join(f"x{rng.randrange(999)}" if i % every == every - 1 else w for i, w in enumerate(text.split()))


@pytest.fixture(scope="module")
def docs(spark):
    base = prose(1, 300)
    texts = [base, base.replace(" ", "\t\n", 3), edit(base, 60, 1), edit(base, 70, 2), prose(2, 200), None, "", "  ",
             "one two", "one two", prose(3, 6000), prose(4, 20) + " " + " ".join(base.split()[50:120]), "é " * 40]
    rows = [(i, t, "clash", "en", "s", 0) for i, t in enumerate(texts)]
    rows += [(4, texts[4], "clash", "en", "s", 0), (None, texts[4], "clash", None, None, None), (99, "one  two", "", "", "", 1)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def words(text):
    return (text or "").encode().split()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SMOKE)
    asked = con.execute(queries.SQL[name])
    order = [[d[0] for d in asked.description].index(c) for c in df.columns]
    assert sorted(map(str, rows_of(df))) == sorted(str(tuple(r[i] for i in order)) for r in asked.fetchall())


@pytest.mark.parametrize("budget", [1 << 20, 3000])
def test_exact_dedup(docs, budget):
    groups = collections.defaultdict(list)
    for i, t, *_ in docs.collect():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    got = rows_of(exact_dedup.exact_dedup(docs, table_bytes=budget))  # the small table spills over several levels
    assert sorted(map(str, [g[:3] + g[4:] for g in got])) == sorted(map(str, want))
    assert sum(g[3] for g in got) == len(groups) == exact_dedup.drop_exact_duplicates(docs).count()


def test_substring_dedup(docs):
    first, all_rows = {}, [(i, words(t)) for i, t, *_ in docs.collect()]
    rank = lambda i: (i is None, i or 0)
    for i, w in all_rows:
        for k in range(len(w) - 12):
            key = tuple(w[k:k + 13])
            first[key] = min(first.get(key, (2, 0)), rank(i))
    want = []
    for i, w in all_rows:
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < rank(i):
                gone.update(range(k, k + 13))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    got = [r[:4] for r in rows_of(substring.substring_digests(docs))]
    assert sorted(map(str, got)) == sorted(map(str, want))


def shingles(text):
    w = words(text)
    return collections.Counter([tuple(w[k:k + 5]) for k in range(len(w) - 4)] or ([tuple(w)] if w else [()]))


def test_near_duplicates(spark, docs):
    base = prose(9, 150)
    more = [(100 + i, edit(base, 10 + i % 40, i), "", "", "", 0) for i in range(60)]
    both = docs.unionByName(spark.createDataFrame(more, DOCS)).where("doc_id is not null").dropDuplicates(["doc_id"])
    sets = {i: shingles(t) for i, t, *_ in both.collect()}
    comp = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            least = sum((sets[a] & sets[b]).values())
            if a < b and least >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - least):
                x, y = comp[a], comp[b]
                comp = {k: min(x, y) if v in (x, y) else v for k, v in comp.items()}
    got = {r.doc_id: r.class_id for r in dartminhash.near_duplicates(both).collect()}
    assert got == comp
    assert dartminhash.drop_near_duplicates(docs).count() == dartminhash.near_duplicates(docs).where("kept").count()


def test_block_links_join_all_classes():
    texts = pa.array([prose(5, 100), edit(prose(5, 100), 99, 1), prose(6, 100), prose(5, 100) + " tail"])
    found = dartminhash.linked_classes(texts, np.arange(4), 0.8)
    assert len(found) == 2 and {x for p in found for x in p} == {0, 1, 3}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 20)] + [(50, 51), (51, 50), (60, 60), (None, 3)]
    got = {r.node: r.comp for r in components.connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 50: 50, 51: 50}


def test_decontaminate(spark, docs):
    item = prose(20, 40, 5000)
    bench = spark.createDataFrame([(1, item), (2, "too short"), (3, None), (4, prose(21, 30, 5000))], "item_id bigint, text string")
    planted = [(200, prose(30, 100) + " " + item + " " + prose(31, 90), "", "", "", 0),
               (201, prose(32, 50) + " " + edit(item, 6, 1).upper(), "", "", "", 0),
               (202, prose(33, 300, 5000), "", "", "", 0)]
    both = docs.unionByName(spark.createDataFrame(planted, DOCS))
    got = {(r.doc_id, r.item_id): r for r in decontaminate.benchmark_copies(both, bench, block_words=10).collect()}
    assert set(got) == {(200, 1), (201, 1)}
    assert (got[200, 1].similarity, got[200, 1].first_word, got[200, 1].end_word) == (1.0, 100, 140)
    clean = decontaminate.drop_contaminated(both, bench)
    assert clean.columns == both.columns and clean.count() == both.count() - 2


def copies(spark, texts, items):
    docs = spark.createDataFrame([(i, t, "", "", "", 0) for i, t in texts], DOCS)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = [(r.doc_id, r.item_id) for r in decontaminate.benchmark_copies(docs, bench).collect()]
    assert decontaminate.drop_contaminated(docs, bench).count() == len(texts) - len({d for d, _ in got})
    return sorted(got)


def test_decontaminate_short_items_and_scripts_without_spaces(spark):
    chinese, thai = "\u571f\u661f\u6700\u5927\u7684\u536b\u661f\u662f\u4ec0\u4e48\uff1f\u571f\u536b\u516d\u3002", "\u0e01\u0e23\u0e38\u0e07\u0e40\u0e17\u0e1e\u0e21\u0e2b\u0e32\u0e19\u0e04\u0e23"
    items = [(1, "Name Saturn's largest moon."), (2, "Titan!"), (3, "two words"), (4, chinese), (5, thai), (6, "\u5730\u7403"), (7, "..."),
             (8, "name saturn s LARGEST moon")]
    texts = [(10, prose(1, 30) + " name Saturn's largest moon " + prose(2, 9)), (11, "name saturn's moon, the largest"), (12, "A titan."),
             (13, "two, and words two"), (14, "\u95ee" + chinese.replace("\uff1f", "?") + "\u7b54"), (15, "\u0e02" + thai + "\u0e02"), (16, "\u5927\u5730\u7403\u4f53"), (17, "two"),
             (18, "words"), (19, "Two\u00a0words")]
    assert copies(spark, texts, items) == [(10, 1), (10, 8), (12, 2), (14, 4), (15, 5), (16, 6), (19, 3)]


def test_decontaminate_folds_beyond_ascii(spark):
    item = "Où était l'élève très âgé, près du fleuve où la Straße à côté s'élève déjà"
    upper = "«\u00a0" + item.replace("'", "\u2019").upper().replace(",", "\u00a0\u2014\u2026") + "\u00a0»"
    apart = unicodedata.normalize("NFD", item).replace(" ", "\u2003")
    wide = "".join(chr(ord(c) + 0xFEE0) if c.isalnum() and c.isascii() else c for c in prose(7, 12))
    assert copies(spark, [(1, upper), (2, apart), (3, prose(3, 40)), (4, wide)], [(1, item), (2, "ÉTÉ déjà"), (3, prose(7, 12))]) == [
        (1, 1), (2, 1), (4, 3)]
    assert copies(spark, [(1, "“été—DÉJÀ”")], [(2, "ÉTÉ déjà")]) == [(1, 2)]



def test_smith_waterman_against_plain_loops():
    rng = np.random.default_rng(1)
    items, passages = rng.integers(2, 6, (20, 7)).astype(np.uint64), rng.integers(2, 6, (20, 11)).astype(np.uint64)
    best, _ = decontaminate.smith_waterman(items, passages)
    for a, b, got in zip(items, passages, best):
        h = np.zeros((8, 12), int)
        for i in range(7):
            for j in range(11):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert h.max() == got


def test_packing(docs):
    got = ga_packing.pack_documents(docs).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(ga_packing.default_tokenizer())
    want = []
    for i, t, *_ in docs.collect():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(i, k, a, len(ids[a:a + 4096]), zlib.crc32(np.array(ids[a:a + 4096], "<u4").tobytes()))
                 for k, a in enumerate(range(0, len(ids), 4096))]
    assert sorted(map(str, [tuple(r)[:5] for r in got])) == sorted(map(str, want))
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), sorted(parts)[1:] + [(sum(n for _, n in parts), 0)]))
        assert sum(n for _, n in parts) <= 4096
    assert len(bins) <= -(-sum(r.length for r in got) // 4096) + 1


def test_tokens_of_odd_words():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(ga_packing.default_tokenizer())
    texts = ["Hello, WORLD!! it's x.y. Σας ΣΑΣ, é́ A. 12, a1. <|endoftext|> ok", "", "İstanbul. ﬁne, 한국어. µ ª",
             "A <|ENDOFTEXT|> B <|endoftext|> <|startoftext|>Cd", "É. É ÀÉ, K Å ǅ ß ẞ Ÿ. x\x1cY A\xa0B DON'T don'T 'S 9A."]
    starts, ids = ga_packing.token_ids(pa.array(texts), ga_packing.default_tokenizer())
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_warc(spark):
    big = "<p>" + "ä" * 900
    rows = [(1, "http://a/%20 b", big), (2, None, big), (3, "x", "small"), (4, "x", "small"), (5, "y", None), (None, "z", big)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'c' AS digest")
    index, folder = warc_index.write_warc(pages, archive_bytes=300)
    got = sorted(map(str, ((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes) for r in warc_index.read_warc(index, folder, 500).collect())))
    assert got == sorted(map(str, [(1, "http://a/%20 b", "revisit", 2, 1803), (2, None, "response", None, 1803), (3, "x", "response", None, 5),
                                   (4, "x", "response", None, 5), (5, "y", "response", None, 0), (None, "z", "revisit", 2, 1803)]))
    assert warc_index.read_warc(index.where("page_id = 3"), folder).count() == 1


def test_chat(spark):
    hard = "\\l<s>|><|x|></s>[INST]\\<<SYS>>[/INST]\\\\"
    rows = [(1, 0, "user", hard), (1, 1, "assistant", hard), (1, 1, None, None), (2, None, "a|>", "x"), (None, 0, "assistant", "é")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS chunk")
    got = {r.conv_id: r for r in chat_bytes.chat_round_trip(turns).collect()}
    order = [("user", hard), ("", ""), ("assistant", hard)]
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in order).encode()).hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256(hard.encode()).hexdigest() and got[1].loss_chars == len(hard)
    assert (got[2].n_turns, got[2].loss_chars, got[None].loss_chars) == (1, 0, 1)


def test_url_redirects(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [(1, "http://A.net/x", ""), (2, "https://b.com/y#f", link.format("https://a.net/x")), (3, "http://c.com/", ""),
            (4, None, None), (5, "no scheme", ""), (6, "http://sub.example.net/en/1", link.format("//d.com/z")), (7, "http://d.com/z?", ""),
            (8, "http://b.com/y", '<meta http-equiv="refresh" content="0; url=/deep">'), (9, "https://b.com/deep", ""), (1, "http://A.net/x", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'n' AS node", "0 AS rule")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_redirects.redirect_verdicts(pages, url_redirects.rules_table(spark)).collect()}
    assert got[1] == ("a.net", "/x", "net/", "block") and got[4] == got[5] == ("", "", None, "allow")
    assert got[2][3] == got[8][3] == got[9][3] == "block" and got[3][3] == "allow"
    assert got[6][2:] == ("example.net/en/", "allow")


def test_url_redirects_take_every_edge(spark):
    rows = [("http://a.net/p", ""), ("http://a.net/q?id=3", ""), ("http://b.com/d/e/f", '<link href="../../up" rel="alternate Canonical">'),
            ("http://b.com/up", "<meta content=\"0;URL='http://a.net/p'\" http-equiv=Refresh>"),
            ("http://c.com/x/y", '<link rel=canonical href=http://c.com/none><link title="a href=/no" rel="canonical" href="z">'),
            ("http://c.com/x/z", '<meta http-equiv=refresh content="5"><meta http-equiv="refresh" content="1; http://a.net/p">'),
            ("http://d.com/s?x", '<base href="//a.net/r/s"><link rel="canonical" href="../q?id=3">'),
            ("http://e.com/s", '<link rel="canonical" href="?a=1&amp;b=2">'), ("http://e.com/s?a=1&b=2", '<link rel="canonical" href="//a.net/p">'),
            ("http://f.com/", '<link rel="canonical" href="/go?u=http://a.net/p"><link rel="stylesheet" href="http://a.net/p">'),
            ("http://g.com/", '<link rel="canonical" href="mailto:a@a.net"><link rel="canonical" href="#http://a.net/">')]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id bigint, url string, html string")
    got = {r.page_id: r.verdict for r in url_redirects.redirect_verdicts(pages, url_redirects.rules_table(spark)).collect()}
    assert [i for i in range(len(rows)) if got[i] == "allow"] == [9, 10]


@pytest.mark.parametrize("target, want", [
    ("g", "/b/c/g"), ("./g/.", "/b/c/g/"), ("g/", "/b/c/g/"), ("/g", "/g"), ("?y", "/b/c/d;p?y"), ("g?y#s", "/b/c/g?y#s"), (";x", "/b/c/;x"),
    (".", "/b/c/"), ("..", "/b/"), ("../g", "/b/g"), ("../../../g", "/g"), ("/./g", "/g"), ("g;x=1/../y", "/b/c/y"), ("g?y/../x", "/b/c/g?y/../x")])
def test_relative_targets(target, want):
    assert url_redirects.resolve("http://a/b/c/d;p?q", target) == "http://a" + want


def test_personal_data(spark):
    text = "Äa x.y@mail.example.com, 10.0.0.256 10.2.3.4\n4111 1111 1111 1111 call +1 (988) 555-2485 now"
    docs = spark.createDataFrame([(1, text, 0), (2, None, 0), (None, "", 0), (4, "none here", 0)], "doc_id bigint, text string, found int")
    got = {r.doc_id: r for r in pii_crf.personal_data_digests(docs).collect()}
    base = f"email:3:23,ip:36:44,card:45:64,phone:{text.index('+')}:{text.index(' now')}"
    assert got[1].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert got[2].spans == got[4].spans == "" and len(got) == 4


def test_viterbi_is_best_path_and_bound_is_safe():
    rng, crf = np.random.default_rng(2), pii_crf.Crf()
    crf.moves = rng.normal(0, 1, crf.moves.shape)
    e = rng.normal(0, 1, (9, 5))
    e[4:, 0] += 20
    line_at = np.array([0, 4, 9])
    got = crf.viterbi(e, line_at[:-1], np.diff(line_at))
    for a, b in zip(line_at, line_at[1:]):
        score = lambda p: sum(e[a + t, y] for t, y in enumerate(p)) + sum(crf.moves[x, y] for x, y in zip(p, p[1:]))  # noqa: E731, B023
        best = max(np.ndindex(*[5] * (b - a)), key=score)
        assert tuple(got[a:b]) == best
    assert crf.outside(e, line_at).tolist() == [False, True] and not got[4:].any()


def test_toxicity_held_out(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        w = prose(i, 30).split()
        if toxic:
            w[rng.randrange(30)] = rng.choice(["moron", "scum", "trash"])
        rows.append((i, " ".join(w), "en"))
        labels.append((i, int(toxic)))
    rows += [(None, None, None), (1000, "", "xx")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "1.0 AS score")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    got = text_cnn.toxicity_scores(docs, marks).collect()
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert len(got) == 602 and all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in got if r.doc_id is not None)
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) > 0.95 * len(held)


def test_empty_tables(spark, docs):
    none = docs.where("false")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    for f in (exact_dedup.exact_dedup, substring.substring_digests, dartminhash.near_duplicates, ga_packing.pack_documents,
              pii_crf.personal_data_digests, lambda d: decontaminate.benchmark_copies(d, bench),
              lambda d: text_cnn.toxicity_scores(d, spark.createDataFrame([], "doc_id bigint, toxic int"))):
        assert f(none).count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc_index.warc_round_trip(pages).count() == 0
    assert url_redirects.redirect_verdicts(pages, url_redirects.rules_table(spark)).count() == 0
    assert chat_bytes.chat_round_trip(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_pipeline_against_brute_force(spark, tmp_path, monkeypatch):
    import corpus_pipeline
    from tokenizers import Tokenizer

    rng, schema = random.Random(8), "doc_id bigint, text string, lang string, source string, n_chars bigint"
    toxic, texts = {i for i in range(500) if i % 4 == 0}, {}
    for i in range(500):
        w = prose(1000 + i, 40 + i % 90, 3000).split()
        if i in toxic:
            w[rng.randrange(len(w))] = rng.choice(["moron", "scum", "trash"])
        texts[i] = " ".join(w)
    item = prose(77, 40, 5000)
    texts |= {600 + i: texts[4 * i + 1].replace(" ", "  \n", 2) for i in range(10)}  # equal after normalising
    texts |= {700 + i: texts[40 * i + 39] * 2 for i in range(10)}
    texts |= {720 + i: edit(texts[700 + i], 60, i) for i in range(10)}
    texts |= {800: prose(78, 60, 3000) + " " + item, 801: prose(79, 30, 3000) + " " + edit(item, 8, 1), 802: None, 803: "", 804: "x y"}
    tables = {"documents": ([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], schema),
              "labels": ([(i, int(i in toxic)) for i in range(500)], "doc_id bigint, toxic int"),
              "benchmark": ([(1, item), (2, prose(80, 30, 5000))], "item_id bigint, text string")}
    for name, (rows, ddl) in tables.items():
        spark.createDataFrame(rows, ddl).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    seen = {}

    def watched(name, stage):
        def call(spark, docs, sf_dir):
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
            seen[name] = {r.doc_id: r.text for r in docs.collect()}
            return stage(spark, docs, sf_dir)
        return name, call

    monkeypatch.setattr(corpus_pipeline, "STAGES", [watched(*s) for s in corpus_pipeline.STAGES])
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert seen["toxicity"] == texts
    gone = set(texts) - set(seen["exact"])
    assert len(gone & toxic) > 0.95 * len(toxic) and len(gone - toxic) <= 3
    first = {}
    for i in sorted(seen["exact"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", seen["exact"][i] or ""), i)
    assert set(seen["near"]) == set(first.values())
    sets = {i: shingles(t) for i, t in seen["near"].items()}
    low, order = {}, sorted(sets)
    for b in order:  # an earlier text that is near, through any chain
        low[b] = b
        for a in order[:order.index(b)]:
            both = sum((sets[a] & sets[b]).values())
            if both >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - both):
                x, y = sorted((low[a], low[b]))
                low = {k: x if v == y else v for k, v in low.items()}
    assert set(seen["decontamination"]) == set(low.values()) and len(set(low.values())) < len(sets)
    assert set(seen["decontamination"]) - set(seen["packing"]) == {800, 801} & set(seen["decontamination"]) != set()
    tokenizer, want = Tokenizer.from_file(ga_packing.default_tokenizer()), {}
    for i, t in seen["packing"].items():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want |= {(i, k): zlib.crc32(np.array(ids[a:a + 4096], "<u4").tobytes()) for k, a in enumerate(range(0, len(ids), 4096))}
    assert {(r.doc_id, r.piece): r.ids_crc32 for r in packed} == want and len(packed) == len(want)
    assert len({r.sequence_id for r in packed}) <= -(-sum(r.length for r in packed) // 4096) + 1
