"""Merkle manifest, ranked search and line dedup against brute force, and on hard input."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.llm import html, lexical, lines, merkle, topk
from panelwright.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
H = lambda s: hashlib.sha256(s.encode()).hexdigest()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ---- op11


def brute_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def brute_sides(levels, i):
    for level in levels[:-1]:
        run = i - i % 8
        yield "".join(level[run:i]), "".join(level[i + 1 : run + 8])
        i //= 8


def brute_manifest(rows):
    """(own, leaf, subroot, root, sides) of rows (lang, id, leaf)."""
    by = collections.defaultdict(list)
    for lang, i, leaf in rows:
        by[lang].append((i is not None, i or 0, leaf))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: brute_levels([leaf for *_, leaf in sorted(by[g])]) for g in langs}
    top = brute_levels([trees[g][-1][0] for g in langs])
    for j, g in enumerate(langs):
        for i, leaf in enumerate(trees[g][0]):
            yield leaf, trees[g][-1][0], top[-1][0], (*brute_sides(trees[g], i), *brute_sides(top, j))


@pytest.fixture(scope="module")
def leafy(spark):
    """One language with more leaves than a stored subtree, some with few, one with one, null, repeated rows and null ids."""
    rows = [(i * 7 % 601, "en", f"t{i}") for i in range(601)] + [(i, "fr", f"u{i}") for i in range(65)] + [(i, None, "v") for i in range(9)]
    rows += [(5, "é", "one"), (None, "fr", "w"), (None, "fr", "x"), (3, None, "v"), (3, None, "v"), (None, "z", None)]
    return spark.createDataFrame(rows, "id long, grp string, pos string")  # names that the operator uses itself


def test_merkle_equals_brute_force(leafy):
    leaf = merkle.digest("id", "grp", "pos")
    rows = [tuple(r) for r in leafy.select("grp", "id", leaf).collect()]
    proved = merkle.manifest(leafy, leaf, "grp", "id")
    got = [(r.leaf, r.subroot, r.root, tuple((s["left"], s["right"]) for s in r.proof)) for r in proved.collect()]
    assert sorted(got) == sorted(brute_manifest(rows))
    checked = proved.select(merkle.fold(F.col("leaf"), F.col("proof")).alias("up"), "root", merkle.fold(F.lit(H("other")), F.col("proof")).alias("wrong"), merkle.proof_digest(F.col("proof")).alias("d"), "proof", "own.*").collect()
    assert all(r.up == r.root != r.wrong and r.d == H("".join(s["left"] + s["right"] for s in r.proof)) for r in checked)
    assert sorted(((r.id, r.grp, r.pos) for r in checked), key=str) == sorted(map(tuple, leafy.collect()), key=str)


def test_merkle_digest_and_small_tables(spark):
    one = spark.createDataFrame([(7, None, "é")], "id long, grp string, pos string")
    leaf = merkle.digest("id", "grp", "pos")
    want = H("1:7-2:é")
    row = merkle.manifest(one, leaf, "grp", "id").first()
    assert (row.leaf, row.subroot, row.root, row.proof) == (want, want, want, [])
    assert merkle.manifest(one.limit(0), leaf, "grp", "id").count() == 0


def test_merkle_stores_every_third_level_only(leafy):
    tree = merkle.grow(leafy.select(F.coalesce("grp", F.lit("")).alias("grp"), F.col("id").alias("by"), merkle.digest("id", "grp", "pos").alias("digest"), F.struct("id").alias("own")))
    assert [t.where("grp = 'en'").count() for t in tree.levels] == [601, 2, 1]


def test_op11_tampered_rows_fail(spark):
    rows = QUERIES["op11_merkle_manifest"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    lowered = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    want = {i: t is None or zlib.crc32(str(i).encode()) % 3 != 0 or lowered(t) == t for i, t in texts.items()}
    assert {r.doc_id: r.verified for r in rows} == want and set(want.values()) == {True, False}


# ---- op12


def brute_search(docs, items, k):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    counts = [(i, collections.Counter(split(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    total, length = len(counts), sum(n for *_, n in counts)
    df = collections.Counter(t for _, c, _ in counts for t in c)
    for item, text in items:
        asked, found = set(split(text)) & set(df), []
        for i, c, n in counts:
            m = 50 + 50 * n * total // length
            found.append((-sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in asked if t in c), 2**63 - 1 if i is None else i))
        for rank, (score, i) in enumerate(sorted(x for x in found if x[0] < 0)[:k], 1):
            yield item, rank, None if i == 2**63 - 1 else i, -score


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 5))) for _ in range(600)]
    share = [1 / (r + 2) for r in range(600)]
    out = [(i, " ".join(rng.choices(words, share, k=rng.randint(0, 60)))) for i in range(900)]
    out += [(900 + i, out[17][1]) for i in range(300)]  # a large group of copies
    out += [(1200, "Word " * 4000), (1201, None), (1202, ""), (None, out[17][1]), (17, out[17][1]), (1203, "-- \n ...")]
    items = [(i, " ".join(rng.choices(words, share, k=rng.randint(1, 14)))) for i in range(25)]
    items += [(25, out[17][1]), (26, None), (27, "unheard of? WORD word"), (28, "!!"), (None, words[0]), (3, words[5]), (29, " ".join(words))]
    return out, items


def test_search_equals_brute_force(spark, prose):
    docs, items = prose
    table, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [(r.item, r.rank, r.doc, r.score) for r in lexical.top_documents(table.repartition(3), asked, 20, segment=200).collect()]
    assert sorted(got, key=str) == sorted(brute_search(docs, items, 20), key=str)


def test_long_items_and_small_batches_are_exact(spark, prose, monkeypatch):
    docs, items = prose
    table, asked = spark.createDataFrame(docs[850:], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical, "LONG", 8)  # items of over eight terms have no bounds
    monkeypatch.setattr(lexical, "TERMS", 200)  # several batches of items
    got = [(r.item, r.rank, r.doc, r.score) for r in lexical.top_documents(table, asked, 5, postings=500).collect()]
    assert sorted(got, key=str) == sorted(brute_search(docs[850:], items, 5), key=str)


def test_search_without_documents_or_terms(spark):
    no_docs, no_items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some_docs, some_items = spark.createDataFrame([(1, "a b")], no_docs.schema), spark.createDataFrame([(1, "a")], no_items.schema)
    assert lexical.top_documents(no_docs, some_items).count() == 0
    assert lexical.top_documents(some_docs, no_items).count() == 0
    assert lexical.top_documents(some_docs, spark.createDataFrame([(1, "?")], no_items.schema)).count() == 0
    clash = some_docs.withColumn("doc", F.lit("x")).withColumn("segment", F.lit(1))
    assert [tuple(r) for r in lexical.top_documents(clash, some_items).collect()] == [(1, 1, 1, lexical.weight(1, 1) * (10**9 // 3000))]


def test_blocks_are_skipped_and_maxima_are_exact(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select(F.col("doc_id").alias("doc"), "text")
    items = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").select(F.col("item_id").alias("item"), "text")
    batch = next(lexical.item_batches(items))
    vocabulary = np.unique(np.concatenate([np.array(r.terms, np.int64).view(np.uint64) for r in batch]))
    counted = lexical.written(docs.mapInArrow(lexical._counted(vocabulary), "doc long, n long, terms array<int>, tfs array<int>"))
    n, length = counted.agg(F.count("*"), F.sum("n")).first()
    held = np.zeros(len(vocabulary), np.int64)
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        held[r.t] = r["count"]
    of = lexical._batch(batch, vocabulary, held, n, length)
    search, pairs = lexical.Search(of, 50, np.ones(len(batch), np.int64)), 0
    for row in lexical.index(counted, of).toLocalIterator():
        starts, terms, impact = np.concatenate([[0], np.cumsum(row.counts)]), np.array(row.terms), np.array(row.impacts, np.int64)
        names, sizes, members, tables = (np.array(x, np.int64) for x in (row.lists, row.sizes, row.members, row.maxima))
        search.segment(np.array(row.docs), starts, terms, impact, names, sizes, members, tables)
        doc = np.repeat(np.arange(len(row.docs)), row.counts)
        pairs += sum(len(np.unique(doc[np.isin(terms, a)])) for a in of.asked)
        at = 0
        for t, size, end in zip(names.tolist(), sizes.tolist(), np.cumsum(sizes).tolist()):
            if size < lexical.SHORT:
                continue
            for begin in range(end - size, end, lexical.BLOCK):
                if t % 50 == 0:
                    mine = np.isin(doc, members[begin : min(end, begin + lexical.BLOCK)])
                    want = [max(impact[mine & (terms == x)], default=0) for x in of.near[t]]
                    assert tables[at : at + len(of.near[t])].tolist() == want
                at += len(of.near[t])
    print(f"{search.scored} of {pairs} documents that hold a term of the item were scored")
    assert search.scored < 0.6 * pairs


# ---- op4

WEIGHTS = {"word": 0.5, "other": -1.0, "p": -0.3, "div": -0.5, "article": -0.5, "section": -0.3, "h2": -0.2}
LONG = " ".join(f"word{i}" for i in range(60))


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<div class='content with-sidebar'><article><p>{LONG}</p></article></div>", LONG),
        (f"<div class='post no-comments has-sidebar'><p>{LONG}</p></div>", LONG),
        (f"<article><p>{LONG}</p><section id='related-work'><h2 id='search-algorithms'>Search</h2><p>kept {LONG}</p></section></article>", f"{LONG}\nSearch\nkept {LONG}"),
        (f"<div><article><p>{LONG}</p></article><article><p>two {LONG}</p></article></div>", f"{LONG}\ntwo {LONG}"),
        (f"<body><div><p>{LONG}</p></div><div><p>two {LONG}</p></div></body>", f"{LONG}\ntwo {LONG}"),
        (f"<form id='aspnet'><div class='page'><p>{LONG}</p></div></form>", LONG),
        (f"<div class='widget'><main><p>{LONG}</p></main></div>", LONG),
        (f"<div class='ad-slot'>{'buy now ' * 9}</div><article><p>{LONG}</p><div id='comments'><p>{LONG} {LONG}</p></div></article><div class='cookieNotice'>ok</div>", LONG),
        (f"<div class='site-footer'>all rights</div><div><p>{LONG}</p></div><ul class='share-buttons'><li>send</li></ul>", LONG),
        (f"<article><p>a</p></article><article class='teaser'><p>{LONG}</p></article>", "a"),
        ("<article></article>", ""),
        (f"<article><p>{LONG * 3000}</p></article>", LONG * 3000),
    ],
)
def test_main_text_of_hard_pages(page, want):
    assert html.extract(page, WEIGHTS) == want


def test_best_run_equals_brute_force():
    rng = random.Random(7)
    for _ in range(200):
        found = [(rng.choice(["p", "div", "x"]), "", False) if rng.random() < 0.6 else ("", "w " * rng.randint(0, 4), False) for _ in range(rng.randint(0, 14))]
        score = [WEIGHTS.get(n, -1.0) if n else 0.5 * len(t.split()) for n, t, _ in found]
        best = max([sum(score[a:b]) for a in range(len(score)) for b in range(a, len(score) + 1)], default=0.0)
        first, end = html.best_run(found, WEIGHTS)
        assert math.isclose(sum(score[first:end]), best, abs_tol=1e-9)


# ---- op10


def test_sorted_lists_are_not_read_whole(spark):
    vectors = topk.scaled(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding"))
    rows = [(r.id, r.v) for r in vectors.collect()]
    ids, matrix = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    asked = ids % 100 == 0
    scores = matrix[asked] @ matrix.T
    want = [sorted(zip((-scores[j][ids != q]).tolist(), ids[ids != q].tolist()))[:10] for j, q in enumerate(ids[asked])]
    search = topk.Search(ids[asked], matrix[asked], np.full(asked.sum(), -np.inf), 10)
    for row in topk.blocks(vectors, 500).collect():
        search.block(*(np.array(row[c]) for c in ("ids", "listed", "places")))
    assert [list(zip((-s).tolist(), i.tolist())) for i, s in search.best] == want
    # the first of four blocks is read whole, as no bound is known
    print(f"{search.read} of {search.entries} entries read")
    assert search.read < 0.85 * search.entries


@pytest.mark.parametrize("scale", [1, 2**20])
def test_bounds_hold_for_clustered_and_large_vectors(scale):
    rng = np.random.default_rng(8)
    matrix = (np.repeat(rng.integers(-500, 500, (8, 12)), 60, axis=0) + rng.integers(-20, 20, (480, 12))) * scale
    ids, search = np.arange(480), topk.Search(np.arange(0, 480, 7), matrix[::7], np.full(69, -np.inf), 5)
    for start in range(0, 480, 60):
        part = matrix[start : start + 60]
        order = np.argsort(part, axis=0)
        search.block(ids[start : start + 60], np.take_along_axis(part, order, axis=0).T.ravel(), order.T.ravel())
    for q, (found, score) in zip(range(0, 480, 7), search.best):
        exact = [(sum(int(a) * int(b) for a, b in zip(matrix[q], matrix[i])), i) for i in range(480) if i != q]
        assert list(zip(score.tolist(), found.tolist())) == sorted(exact, key=lambda p: (-p[0], p[1]))[:5]
    assert search.read < 0.6 * search.entries  # blocks of other clusters are skipped


# ---- op13


def brute_lines(rows, least=10):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    first, held = {}, collections.defaultdict(set)
    split = [(2**63 - 1 if i is None else i, (t or "").split("\n")) for i, t in rows]
    for i, ls in split:
        for k in map(key, ls):
            first[k] = min(first.get(k, i), i)
            held[k].add(i)
    for i, ls in split:
        kept = [x for x in ls if not (len(key(x)) >= least and len(held[key(x)]) > 1 and first[key(x)] < i)]
        yield i, len(ls), len(ls) - len(kept), "\n".join(kept)


@pytest.fixture(scope="module")
def lined():
    rng = random.Random(9)
    pool = ["".join(rng.choice("abcXYZé ") for _ in range(rng.randint(6, 16))) for _ in range(150)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    rows += [(i, f"  A very Common line\t\n\nown {i} line here\r\na very common LINE") for i in range(80, 200)]
    rows += [(300, None), (301, ""), (302, "\n\n"), (303, "É very common line"), (304, "é very common line"), (None, rows[100][1]), (None, "nothing else like it"), (None, None)]
    return rows + [(7, rows[7][1]), (7, rows[8][1]), (305, "\x1c padded line \x1c"), (306, "padded line"), (307, "\n".join(f"line number {i % 3000}" for i in range(6000))), (308, "line number 17\n")]


@pytest.mark.parametrize("shard", [lines.SHARD, 16])
def test_lines_equal_brute_force(spark, lined, monkeypatch, shard):
    monkeypatch.setattr(lines, "SHARD", shard)
    monkeypatch.setattr(lines, "HEAVY", 1 << 16 if shard > 16 else 40)
    docs = spark.createDataFrame(lined, "doc_id long, text string").withColumn("doc", F.lit(1)).withColumn("of", F.lit("x"))
    got = [(2**63 - 1 if r.rest.doc_id is None else r.rest.doc_id, r.n_lines, r.n_dropped, r.kept) for r in lines.dedup_lines(docs).collect()]
    assert sorted(got) == sorted(brute_lines(lined))
    if shard == 16:  # the common line's shard is in pieces
        rows = docs.select(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc"), "text")
        assert lines.shards(rows, 10, 2)[0].where("pieces > 1").count()


def test_lines_of_an_empty_table(spark):
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        a, b = (rng.integers(0, 2**63, n, np.int64).view(np.uint64) for _ in range(2))
        a[: n // 2] = a[:1]  # one hash alone doesn't tell them apart
        sizes, bits = lines.perfect(a, b)
        assert sorted(lines.place(a, b, sizes, bits).tolist()) == list(range(n))
        assert n < 5000 or len(bits) < 6 * n
