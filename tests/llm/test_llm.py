"""The training-data operators against brute force, round trips and libraries, and on hard input."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from panelwright.llm import bpe, chat, html, language, mixing, near_docs, search, similar, substrings, suffix_tree, topk, vptree
from panelwright.llm.queries import TOKENIZER
from panelwright.llm.simhash import shingle_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    passage = " ".join(rng.choice(words) for _ in range(30))
    out = []
    for i in range(60):
        body = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        if i % 4 == 0:
            body.insert(len(body) // 2, passage)
        out.append(" ".join(body))
    out += [out[4], out[4] + " more", None, "", "   \n", "x" * 5000, "Hello <|endoftext|> it's 12³ 日本　 a", "ok " * 3000]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ["en", "fr", None][i % 3], ["a", "b", "é", None][min(i % 5, 3)], len(t or "")) for i, t in enumerate(texts)]
    rows += [(4, texts[4], "en", "a", 1), (None, texts[8], None, None, None)]  # a repeated row, a null id
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_bpe_equals_library(docs):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coded = bpe.decode(bpe.encode(docs, TOKENIZER), TOKENIZER).collect()
    assert len(coded) == docs.count()
    for r in coded:
        want = lib.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want
        assert r.decoded == lib.decode(want, skip_special_tokens=False) == (r.text or "")


def test_bpe_clashing_column_and_empty(docs, empty):
    assert bpe.encode(docs.withColumn("ids", F.lit("x")), TOKENIZER).columns.count("ids") == 1
    assert bpe.decode(bpe.encode(empty, TOKENIZER), TOKENIZER).count() == 0


def brute_cut(rows, length=13):
    first = {}
    split = [(i if i is not None else 2**63 - 1, WORD.findall(t or "")) for i, t in rows]
    for i, ws in split:
        for s in range(len(ws) - length + 1):
            key = tuple(ws[s : s + length])
            first[key] = min(first.get(key, i), i)
    for i, ws in split:
        gone = {s + o for s in range(len(ws) - length + 1) if first[tuple(ws[s : s + length])] < i for o in range(length)}
        yield i, len(ws), len(gone), " ".join(x for k, x in enumerate(ws) if k not in gone)


def test_substrings_equal_brute_force(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [(r.rest.doc_id if r.rest.doc_id is not None else 2**63 - 1, r.n_words, r.n_removed, r.kept) for r in substrings.dedup_substrings(docs).collect()]
    assert sorted(got) == sorted(brute_cut(rows))
    assert sum(r[2] for r in got) > 300
    assert substrings.without_repeats(docs).columns == docs.columns
    assert substrings.dedup_substrings(empty).count() == 0


def test_uncut_documents_keep_their_layout(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    plain, rows = "def f(x):\n\n    return  x\t+ 1\n", "id long, text string, n_chars int"
    cut = substrings.without_repeats(
        spark.createDataFrame([(0, passage, 1), (1, plain, 7), (2, None, None), (3, f"  one\n two\n\n{passage}\n\nthree\n", 9), (4, f"a  b {passage}\n\nc", 3), (5, passage, 2)], rows), "id"
    )
    want = [(0, passage, 1), (1, plain, 7), (2, None, None), (3, "  one\n two\n\nthree\n", 18), (4, "a  b\n\nc", 7), (5, "", 0)]
    assert sorted(map(tuple, cut.collect())) == want


def test_substrings_of_null_and_repeated_ids(spark, monkeypatch):
    rng = random.Random(8)
    passages = [" ".join(f"p{i}x{k}" for k in range(30)) for i in range(20)]
    rows = [(i, f"{p} own{i}") for i, p in enumerate(passages)]
    rows += [(None if i % 2 else 7, " ".join([f"u{i}", passages[i % 20], f"v{rng.random()}", passages[(i * 3 + 1) % 20]])) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    cut = substrings._cut

    def counted(length, layout):
        run = cut(length, layout)

        def watch(batches):
            for batch in batches:  # a text carries its own windows only
                assert all(len(x or []) <= 60 for x in batch.column(3).to_pylist())
                yield from run(iter([batch]))

        seen.append(length)
        return watch

    monkeypatch.setattr(substrings, "_cut", counted)
    got = [(r.rest.doc_id if r.rest.doc_id is not None else 2**63 - 1, r.n_words, r.n_removed, r.kept) for r in substrings.dedup_substrings(frame).collect()]
    assert seen and sorted(got) == sorted(brute_cut(rows))


def test_pieces_of_a_source_with_null_ids(spark, monkeypatch):
    rows = spark.createDataFrame([(None, f"some words {i}", "a") for i in range(400)] + [(3, f"more {i}", "a") for i in range(200)], "doc_id long, text string, source string")
    assert mixing.numbered(rows).groupBy("bucket").count().agg(F.max("count")).first()[0] < 10
    monkeypatch.setattr(mixing, "BUCKETS", 2)
    monkeypatch.setattr(mixing, "ROWS", 6)  # 600 rows ask for 100 pieces
    assert 50 < mixing.numbered(rows).select("bucket").distinct().count() <= 100
    placed = mixing.numbered(rows).select("off", "size").orderBy("off").collect()
    assert [r.off for r in placed] == [sum(r["size"] for r in placed[:i]) for i in range(len(placed))]


def test_mixing(docs, empty):
    rows = mixing.mix_report(docs).collect()
    assert sorted(rows, key=str) == sorted(mixing.mix_report(docs.repartition(7)).collect(), key=str)
    size = lambda t: len(WORD.findall(t or ""))
    assert sorted((r.doc is None, r.doc or 0, r["size"]) for r in rows) == sorted((r.doc_id is None, r.doc_id or 0, size(r.text)) for r in docs.collect())
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    by = collections.defaultdict(int)
    for r in docs.collect():
        by[r.source] += size(r.text)
    names = sorted([s for s in by if s is not None]) + [None]
    weight, target, left = {s: 1 + i % 3 for i, s in enumerate(names)}, {}, dict.fromkeys(names)
    total = sum(by.values())
    while True:
        share = (total - sum(target.values())) / sum(weight[s] for s in left)
        over = [s for s in left if weight[s] * share > 3 * by[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * by[s]
            del left[s]
    target |= {s: weight[s] * share for s in left}
    taken = collections.defaultdict(int)
    for r in rows:
        source = next(s for s in names if by[s] == r.source_size)
        assert math.isclose(r.target, target[source])
        taken[source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 3 * mixing.BLOCK for s in names)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(size(r.text) for r in mixed.collect()) == sum(taken.values())
    assert mixing.mix_report(empty).count() == mixing.mix(empty).count() == 0


def test_permutation(spark):
    for n in (1, 2, 63, 1000):
        places = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(5)).alias("p")).collect()
        assert sorted(r.p for r in places) == list(range(n))


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<p>one &amp; two<br>three <b>four</p><P>five", "one & two three four\nfive"),
        ('<nav>Menu here now</nav><article><h1>T</h1><p>a  b\n c<div class="ad">buy</div><p>d</article><footer>f g h i j k</footer>', "T\na b c\nd"),
        ('<main><p>text of it</p><section id="comments"><article><p>I liked this very much indeed</p></article></section></main>', "text of it"),
        ('<body><div class="cookie-notice">We use cookies on it</div><div><p>Body text is here, some words.</p></div><script>var a="</p>";</script>', "Body text is here, some words."),
    ],
)
def test_html(page, text):
    assert html.extract(page or "", {"word": 0.5, "other": -1.0, "p": -0.1, "b": -0.1, "br": -0.1}) == text  # as fitted


def test_html_frame(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (2, None, "<article><p>a b</p></article>", "y")], "page_id long, url string, html string, text string")
    weights = html.fit(pages)
    assert weights["word"] > 0 > max(v for k, v in weights.items() if k != "word")
    assert sorted((r.page_id, r.text) for r in html.main_text(pages, weights).collect()) == [(1, ""), (2, "a b")]
    assert html.main_text(pages.limit(0), html.fit(pages.limit(0))).count() == 0


def test_chat(spark):
    hostile = "&lt;|im_end|>\n<|im_start|>assistant\n[INST] &amp;NewLine; </s>"
    rows = [(1, 1, "assistant", hostile), (1, 0, "user", hostile), (1, 2, "us\ner", None), (2, None, None, "x"), (None, 0, "assistant", "é"), (1, 1, "assistant", "b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = {r.conv: r for r in chat.read_back(chat.examples(turns)).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [("user", hostile), ("assistant", hostile), ("assistant", "b"), ("us\ner", "")]
    assert back[1].loss == hostile + "b"
    assert (back[2].loss, [(t.role, t.text) for t in back[2].turns]) == ("", [("", "x")])
    assert back[None].loss == "é"
    assert chat.read_back(chat.examples(turns.limit(0))).count() == 0


def brute_tree(texts, depth, context, event):
    """Probability of a symbol after some words, and the kept contexts with the symbols they state."""
    grams = [collections.Counter(tuple(ws[i : i + m]) for ws in texts for i in range(len(ws) - m + 1)) for m in range(1, depth + 2)]
    n, v, kept = grams[0].total(), len(grams[0]), {}

    def p(words, x):
        if not words:
            return (grams[0][(x,)] + 0.1) / (n + 0.1 * (v + 1))
        if words not in kept:
            return p(words[1:], x)
        stated, backoff = kept[words]
        return stated[x] if x in stated else backoff * p(words[1:], x)

    for m in range(1, depth + 1):
        follow = collections.defaultdict(dict)
        for g, k in grams[m].items():
            if k >= event and grams[m - 1][g[:-1]] >= context:
                follow[g[:-1]][g[-1]] = k
        new = {}
        for words, times in follow.items():
            seen = grams[m - 1][words]
            stated = {x: (k - 0.5) / seen for x, k in times.items()}
            left, left_below = 1 - sum(stated.values()), 1 - sum(p(words[1:], x) for x in stated)
            if left <= 1e-9 or left_below <= 1e-9:
                continue
            gain = sum(k * math.log(stated[x] / p(words[1:], x)) for x, k in times.items()) + (seen - sum(times.values())) * math.log(left / left_below)
            if gain > 0.5 * (len(times) + 1) * math.log(seen):
                new[words] = stated, left / left_below
        kept |= new
    return p, kept


# all terms heavy; heavy and light ones; no heavy terms and full bitmaps
@pytest.mark.parametrize("heavy, bits", [(1e-6, 26), (0.004, 20), (2.0, 4)])
def test_suffix_tree_equals_brute_force(spark, docs, monkeypatch, heavy, bits):
    # four words back decide
    docs = docs.unionByName(spark.createDataFrame([(100 + i, f"k{i % 2} m n o Z{i % 2}\n" * 9, None, None, None) for i in range(12)], DOCS))
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for name, value in (("HEAVY", heavy), ("BITS", bits), ("CONTEXT", 4), ("EVENT", 2)):
        monkeypatch.setattr(suffix_tree, name, value)
    training = suffix_tree.is_training()
    counts, words = suffix_tree.count_words(docs.where(training))
    tree = suffix_tree.learn(docs.where(training), counts, words, depth=4)
    got = suffix_tree.score(docs, counts, tree).collect()
    assert len(got) == docs.count()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    split = [(r.doc_id, [*WORD.findall((r.text or "").translate(low)), None]) for r in docs.collect()]
    c = collections.Counter(x for i, ws in split if not held(i) for x in ws)
    n, v = sum(c.values()), len(c)
    p, kept = brute_tree([ws for i, ws in split if not held(i)], 4, 4, 2)
    assert {len(known) for known in kept} == {1, 2, 3, 4}
    assert tree.table.count() == sum(1 + len(stated) for stated, _ in kept.values())
    for words_, (stated, backoff) in list(kept.items())[::40]:  # distributions sum to one, the last is that of an unknown word
        assert math.isclose(sum(p(words_, x) for x in c) + p(words_, "never seen"), 1, rel_tol=1e-9)
    want = collections.Counter()
    for i, ws in split:
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in ws)
        model = sum(math.log10(p(tuple(ws[max(k - 4, 0) : k]), x)) for k, x in enumerate(ws))
        want[i, len(ws), sum(c[x] > 0 for x in ws), round(base, 6), round(model, 6)] += 1
    assert words.tokens == n
    assert collections.Counter((r.id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in got) == want
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_suffix_tree_without_training_rows(docs, empty):
    counts, words = suffix_tree.count_words(empty)
    tree = suffix_tree.learn(empty, counts, words)
    assert suffix_tree.score(empty, counts, tree).count() == 0
    assert all(r.n_known == 0 and r.score == r.base_score for r in suffix_tree.score(docs, counts, tree).collect())


def test_gram_keys_are_those_of_spark(spark):
    rng = np.random.default_rng(4)
    a, b = rng.integers(-(2**63), 2**63 - 1, (2, 50))
    rows = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a long, b long")
    want = [r[0] for r in rows.select(F.xxhash64("a", "b")).collect()]
    assert suffix_tree.gram_keys(a.view(np.uint64), b.view(np.uint64)).view(np.int64).tolist() == want


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    training = language.is_training()
    rows = language.predict(docs.where(~training), language.fit(docs.where(training))).where("lang_pred <> 'und'").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows) > 0


def test_language_edges(docs, empty):
    model = language.fit(docs)
    got = {r.doc_id: r for r in language.predict(docs.withColumn("score", F.lit(9)), model).collect()}
    assert {got[i].lang_pred for i in (62, 63, 64)} == {"und"} and got[62].score == 0
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.predict(docs, language.fit(empty)).where("lang_pred <> 'und'").count() == 0
    assert language.identified(docs).columns == docs.columns


def brute_groups(fps, radius):
    root = {d: d for d, _ in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in fps:
        for b, y in fps:
            if (x ^ y).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {d: find(d) for d, _ in fps}


def test_near_duplicates_equal_brute_force(docs, empty):
    fps = []
    for r in docs.collect():
        h = shingle_hashes((r.text or "").encode()).tolist()
        fp = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        fps.append((r.doc_id if r.doc_id is not None else 2**63 - 1, fp))
    want = brute_groups(fps, 2)
    got = near_docs.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        key = r.id if r.id is not None else 2**63 - 1
        assert r.component == want[key] and (key, r.fp % 2**64) in fps
    kept = near_docs.keep_first(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert kept.columns == docs.columns and near_docs.near_duplicates(empty).count() == 0


def test_near_documents_without_unique_ids_stay(spark):
    words = lambda i, n=60: " ".join(f"w{(i * 7919 + j * j * (i + 3)) % 997}" for j in range(n))
    rows = [(None, words(i)) for i in range(6)] + [(5, words(i)) for i in range(10, 14)] + [(5, words(2)), (9, words(3)), (9, words(3))]
    kept = near_docs.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(None, words(i)) for i in (0, 1, 4, 5)] + [(5, words(i)) for i in range(10, 14)] + [(5, words(2)), (9, words(3))]
    assert sorted(map(str, kept)) == sorted(map(str, spark.createDataFrame(want, "doc_id long, text string").collect()))
    found = near_docs.near_duplicates(spark.createDataFrame([(1, words(1)), (2, words(1)), (2, words(2)), (3, words(2))], "doc_id long, text string")).collect()
    assert sorted((r.id, r.component) for r in found) == [(1, 1), (2, 1), (2, 2), (3, 2)]


def test_similar_documents_equal_brute_force(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    rows = []
    for i in range(40):
        body = [rng.choice(words) for _ in range(rng.choice([3, 40, 150, 400]))]
        rows.append((i, " ".join(body)))
        for share in (0.005, 0.015, 0.03, 0.1):
            near = list(body)
            for at in range(len(near)):
                near[at] = rng.choice(words) if rng.random() < share else near[at]
            rows.append((len(rows) + 1000, "\n".join(near).upper() if i % 5 == 0 else "  ".join(near)))
    rows += [(None, rows[0][1] + " more"), (None, None), (3000, ""), (3001, " \n")]
    sets = []
    for _, t in rows:
        ws = (t or "").lower().split()
        sets.append({tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))})
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    root = list(range(len(rows)))
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if alike(sets[a], sets[b])]
    while any(root[a] != root[b] for a, b in pairs):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    groups = collections.defaultdict(list)
    for i, r in enumerate(root):
        groups[r].append(rows[i][0] if rows[i][0] is not None else 2**63 - 1)
    kept = similar.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == sorted(map(min, groups.values())) and len(groups) < len(rows) - 60
    stage = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert stage.count() == len(groups)


def test_pipeline_links_by_fingerprint(spark, monkeypatch):
    """SimHash and vantage-point shards alone, no MinHash key shared, link likely pairs of the pipeline's stage."""
    rng = random.Random(4)
    body = [f"w{rng.randrange(5000)}" for _ in range(400)]
    rows = [(1, " ".join(body)), (2, " ".join([*body[:-1], "end"])), (3, " ".join(body[::-1])), (4, "  ".join(body)), (5, None), (6, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    texts = frame.select(F.col("doc_id").alias("t"), F.coalesce("text", F.lit("")).alias("text"))
    pairs = {(max(r), min(r)) for r in similar.near_fingerprints(texts).collect()}
    assert {(2, 1), (4, 1), (6, 5)} <= pairs and not {3} & {x for pair in pairs for x in pair}
    monkeypatch.setattr(similar, "_key_rows", lambda size: lambda batches: iter(()))
    assert sorted(r.doc_id for r in similar.keep_first(frame).collect()) == [1, 3, 5]


def like_groups(rows, size=5, likeness=0.8):
    """The smallest id of each group of texts (id, text) linked by their likeness, by brute force."""
    sets = []
    for _, t in rows:
        ws = t.lower().split()
        sets.append({tuple(ws[k : k + size]) for k in range(max(1, len(ws) - size + 1))})
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= likeness * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return sorted({min(i for (i, _), r in zip(rows, root) if r == group) for group in root})


@pytest.mark.parametrize("part", [4 << 20, 400_000])
def test_all_texts_of_a_ball_are_compared(spark, monkeypatch, part):
    """Texts of one SimHash whose first and nearest are not alike still meet the others, in one part or in several."""
    rng = random.Random(12)
    said = [f"s{i}" for i in range(41)] * 400
    rows = []
    for i in range(12):
        tail = [f"w{rng.randrange(50000)}" for _ in range(100)]
        rows.append((len(rows), " ".join(said + tail)))
        if i % 2:
            rows.append((len(rows), " ".join([*said, *tail[:50], "new", *tail[51:]])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    texts = frame.select(F.xxhash64("text").alias("t"), "text")
    assert len(similar.near_fingerprints(texts).distinct().collect()) < len(rows) + 20  # links of all texts, not all their pairs
    monkeypatch.setattr(similar, "_key_rows", lambda size: lambda batches: iter(()))
    monkeypatch.setattr(similar, "PART", part)
    want = like_groups(rows)
    assert len(want) == 12 and sorted(r.doc_id for r in similar.keep_first(frame).collect()) == want


def test_all_texts_of_a_key_are_compared(spark, monkeypatch):
    rng = random.Random(13)
    rows = []
    for i in range(30):
        body = [f"w{rng.randrange(50000)}" for _ in range(60)]
        rows += [(len(rows) + k, " ".join(body[k:])) for k in (0, 5, 10, 13)]  # a chain: the ends are less alike
    frame = spark.createDataFrame(rows, "doc_id long, text string")

    def one_key(size):
        def run(batches):
            for batch in batches:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([7] * n, pa.int64()), batch.column(0), pa.array([0] * n, pa.int8())], names=["key", "t", "turn"])

        return run

    monkeypatch.setattr(similar, "_key_rows", one_key)
    want = like_groups(rows)
    assert len(want) < len(rows) - 40 and sorted(r.doc_id for r in similar.keep_first(frame).collect()) == want


def test_alike_groups_equal_brute_force(monkeypatch):
    rng = np.random.default_rng(8)
    for gather in (1 << 20, 64):
        monkeypatch.setattr(similar, "GATHER", gather)
        for likeness in (0.5, 0.8, 1.0):
            sets = [np.empty(0, np.uint64)] * 3
            for _ in range(25):
                base = rng.integers(0, 4000, rng.integers(1, 60))
                sets += [np.unique(np.where(rng.random(len(base)) < p, rng.integers(0, 4000, len(base)), base)).astype(np.uint64) for p in (0, 0.03, 0.08, 0.2)]
            group, side = np.arange(len(sets)) // rng.integers(1, 3), rng.integers(0, 2, len(sets))
            for sides in (np.zeros(len(sets), np.int64), side):
                alike = {(a, b) for a in range(len(sets)) for b in range(a)
                         if (sides is not side or side[a] != side[b]) and len(np.intersect1d(sets[a], sets[b])) >= likeness * len(np.union1d(sets[a], sets[b]))}
                got = list(similar.alike_groups(sets, group, sides, likeness))
                assert all((max(p), min(p)) in alike for p in got)
                own = [(np.array([a]), np.array([b])) for a in range(len(sets)) for b in range(a) if group[a] == group[b]]
                as_pairs = lambda pairs: own + [(np.array([a]), np.array([b])) for a, b in pairs]
                assert (vptree.roots(len(sets), as_pairs(alike)) == vptree.roots(len(sets), as_pairs(got))).all()


def test_nearest_of_a_shard_are_linked():
    fps = np.array([0, 1, 3, 7, 255 << 40], np.int64)
    table = pa.table({"fp": fps, "doc": np.arange(5), "home": np.ones(5, bool)})
    got = vptree.shard_neighbours(1)(table).to_pydict()
    assert set(zip(got["u"], got["v"])) == {(1, 0), (2, 0), (3, 0), (0, 1), (2, 1), (3, 2)}


def test_vantage_point_shards(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 400, dtype=np.int64)
    fps = np.unique(np.concatenate([base, base[:150] ^ (1 << rng.integers(0, 62, 150)), base[:50] ^ 3, base[:20] ^ 15]))
    frame = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps)], "fp long, doc long")
    want = brute_groups([(i, int(f)) for i, f in enumerate(fps)], 2)
    for shard in (16, 100_000):
        nodes = near_docs.components(near_docs.link_fingerprints(frame, 2, shard, sample=10**9)).collect()
        got = {i: i for i in range(len(fps))} | {r.node: r.component for r in nodes}
        assert got == want
    nodes = vptree.grow(base.view(np.uint64), 5)
    at, rows, home = vptree.route(fps.view(np.uint64), nodes, 2)
    assert sorted(rows[home]) == list(range(len(fps))) and len(set(at)) > 8


def test_fingerprints(docs, empty):
    rows = search.with_next(docs).collect()
    order = sorted(((r.doc_id if r.doc_id is not None else 2**63 - 1), r.text or "") for r in docs.collect())[::-1]
    assert sorted((r.doc, r.text) for r in rows) == sorted(order)
    ids = [i for i, _ in order]
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        if ids.count(i) == 1:
            assert [r.next_text for r in rows if r.doc == i] == [following]
    made = search.fingerprinted(docs, {"doc_id": F.col("doc_id"), "text": F.col("text")}, fp="text").collect()
    by_text = collections.defaultdict(set)
    for r in made:
        by_text[r.text].add(r.fp)
    assert all(len(x) == 1 for x in by_text.values()) and by_text[None] == by_text[""] == {0}
    assert search.with_next(empty).count() == 0


def test_near_counts(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 200, dtype=np.int64)
    fps = np.unique(np.concatenate([base, *[base[:60] ^ (1 << rng.integers(0, 62, 60)) ^ (1 << rng.integers(0, 62, 60)) for _ in range(3)]]))
    frame = spark.createDataFrame([(int(f), 1 + i % 3) for i, f in enumerate(fps)], "fp long, rows long")
    want = {int(f): sum(1 + i % 3 for i, g in enumerate(fps) if g != f and int(f ^ g).bit_count() <= 3) for f in fps}
    assert {r.fp: r.near for r in search.near_counts(frame).collect()} == {f: n for f, n in want.items() if n}


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(7, [0.5] * 8), (400, None), (500, [1.0, None]), (600, [float("nan")]), (601, []), (None, [1.0])]
    rows += [(1000 + i, rows[3][1]) for i in range(30)]
    monkeypatch.setattr(topk, "COMPONENTS", 16)  # two queries a batch
    vectors = topk.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    v = [(r.id, np.array(r.v)) for r in vectors.collect()]
    assert len(v) == 331
    got = collections.defaultdict(list)
    for r in topk.top_k(vectors, vectors.where("id % 100 = 0"), 10, block=64).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {i for i, _ in v if i % 100 == 0}
    for q, x in v:
        if q % 100 == 0:
            assert got[q] == sorted(((i, int(x @ y)) for i, y in v if i != q), key=lambda p: (-p[1], p[0]))[:10]
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_pipeline(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and all(r.round_trip for r in rows)
    # brute force of the stages up to the substring cut, against the stages' own results
    step = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, step = step, stage(spark, step, str(tmp_path))
        assert step.columns == docs.columns
        if name == "substring_dedup":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            want = list(brute_cut(rows))
            got = [(r.doc_id if r.doc_id is not None else 2**63 - 1, r.text) for r in step.collect()]
            assert sorted((i, " ".join(WORD.findall(t))) for i, t in got) == sorted((i, kept) for i, _, _, kept in want)
            # texts that are not cut stay as they are
            same = collections.Counter((i, text) for (i, _, n, _), (_, text) in zip(want, rows) if not n)
            assert same and not same - collections.Counter(got)
