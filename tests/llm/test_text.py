"""Main text, quality, language, near-duplicates and pieces."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from stallkeep.llm import langid, neardup, pages, pieces, quality
from stallkeep.llm.common import free_name
from stallkeep.llm.queries import PIECES
from stallkeep.llm.words import Words

ARTICLE = (
    '<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a>Home</a></ul></nav><!-- x --><div class="ad">Buy</div>'
    "<article><header><h1>A &amp; B</h1></header><p><b>One &lt;two&gt;<br>three<p>four &am</p><aside>side</aside><div class='reader comments'>no</div>"
    "<p hidden>gone</p><figure>fig</figure></article><footer>&copy; me</footer>"
)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        (ARTICLE, "A & B One <two> three four &am gone fig"),
        ("<main>a<form>b</form>c", "a c"),
        ("<div role=main>in</div><div>out</div>", "in"),
        ("<article>a<nav>b</article>c", "a"),
        ("<article>x</div></p>y</article>", "x y"),
        ("<article>&nbsp;a\n\t b&#233;</article", "a bé"),
        ("<article>a<p cl", "a"),
        ('<article><p title="a>b">c</p><!-- <p>d</p>', "c"),
        ("<article>a<script>b", "a"),
        ("plain text", "plain text"),
        ('<div class="cookieNotice">x</div><p>y</p>', "y"),
        ("<div class=post>story</div><section class=comments><article class=comment>c</article></section>", "story"),
        ("<p>story</p><aside><article>teaser</article></aside>", "story"),
        ('<div class="post has-sidebar">story</div><div class=sidebar>s</div>', "story"),
    ],
)
def test_main_text_of_one_page(spark, page, text):
    rows = pages.main_text(spark.createDataFrame([(1, "http://a.b/c", page, "z")], "page_id long, url string, html string, text string")).collect()
    expected = text.replace(" gone", "") if page == ARTICLE and "hidden" in pages._NESTING else text
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in rows] == [(1, "http://a.b/c", expected, len(expected))]


def test_unmarked_pages_lose_what_their_host_repeats(spark):
    frame = " ".join(f"menu{k}" for k in range(12))
    rows = [(k, f"https://www.host.org/{k}", f"<div>{frame}</div><div>story {k} alone on page number {k}</div>", 1) for k in range(40)]
    rows += [(100, None, "<p>no host</p>", 1), (None, "http://x.y", "<p>no id</p>", 1), (101, "http://host.org/x", f"<article>{frame}</article>", 1)]
    rows += [(200 + k, "http://copies.org", f"<p>{frame}</p>", 1) for k in range(3)]
    found = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, host int"), chunk_pages=15).collect()
    texts = {r.page_id: r.text for r in found}
    assert len(found) == len(rows)
    assert all(texts[k] == f"story {k} alone on page number {k}" for k in range(40))
    assert texts[100] == "no host" and texts[None] == "no id" and texts[101] == frame
    assert all(texts[200 + k] == frame for k in range(3))  # equal pages count as one


@pytest.mark.parametrize("chunk_pages", [1, 3, 20, 2_000])
def test_unmarked_pages_lose_what_pages_of_other_chunks_repeat(spark, chunk_pages):
    notice = " ".join(f"Notice{k}," for k in range(9))
    rows = [(k, f"https://big.org/{k}", f"<p>{notice if k % 10 == 0 else ''}</p><p>page {k} says what no other page of the {k} says</p>") for k in range(40)]
    rows += [(100 + k, "https://big.org/copy", "<p>" + " ".join(f"w{i}" for i in range(12)) + "</p>") for k in range(4)]  # equal pages count as one
    rows += [(200, "https://small.org/1", f"<p>{notice}</p>")]
    found = {r.page_id: r for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), chunk_pages).collect()}
    assert all(found[k].text == f"page {k} says what no other page of the {k} says" for k in range(40))
    assert all(found[k].shared_tokens == (9 if k % 10 == 0 else 0) for k in range(40))
    assert all(found[100 + k].text == " ".join(f"w{i}" for i in range(12)) and not found[100 + k].shared_tokens for k in range(4))
    assert found[200].text == notice


def test_shared_runs_against_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        some = [[rng.choice("abc") for _ in range(rng.randint(0, 20))] for _ in range(rng.randint(1, 5))]
        for page, covered in zip(some, pages.shared_runs(some, 4)):
            expected = [False] * len(page)
            for k in range(len(page) - 3):
                run = page[k : k + 4]
                if any(o != page and any(o[m : m + 4] == run for m in range(len(o) - 3)) for o in some):
                    expected[k : k + 4] = [True] * 4
            assert covered.tolist() == expected


def clean_text(rng):
    return " ".join(rng.choice(["river", "stone", "light", "under", "walks", "never", "green"]) for _ in range(rng.randint(20, 60))) + "."


def test_quality_learns_and_scores_everything(spark):
    rng = random.Random(2)
    good = [(k, clean_text(rng), "x", 0.5) for k in range(300)]
    bad = [(1000 + k, " ".join(["CLICK!!"] * rng.randint(5, 60)), "x", 0.5) for k in range(300)]
    odd = [(5000, None, None, None), (5001, "", "x", 0.1), (5002, "\n ", "x", 0.1), (None, "text", "x", 0.1), (1, "CLICK!! again", "x", 0.2)]
    docs = spark.createDataFrame(good + bad + odd, "doc_id long, text string, label string, score double")
    labels = [(r[0], int(r[0] < 1000)) for r in good[:200] + bad[:200]] + [(None, 1), (7, None), (9999, 1), (1000, 3), (2, 1)]
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, label int"))
    found = quality.scored(docs, model)
    assert found.columns == ["doc_id", "text", "label", "score", "quality_score"]
    scores = {(r.doc_id, r.text): r.quality_score for r in found.collect()}
    assert len(scores) == len(good + bad + odd)
    assert all(0 <= s <= 1 for s in scores.values())
    assert all(scores[r[:2]] > 0.5 for r in good[200:]) and all(scores[r[:2]] < 0.3 for r in bad[200:])
    one = quality.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, label int"))
    none = quality.fit(docs.limit(0), spark.createDataFrame(labels, "doc_id long, label int"))
    assert {round(r.quality_score, 3) for r in quality.scored(docs, one).collect()} == {0.999}
    assert {r.quality_score for r in quality.scored(docs, none).collect()} == {0.5}
    assert quality.scored(docs.limit(0), model).count() == 0
    clashing = docs.withColumnsRenamed({"score": "quality_score", "text": "Text"})
    with pytest.raises(ValueError):
        quality.scored(clashing, model)
    assert quality.scored(clashing, model, free_name(clashing, "quality_score")).count() == docs.count()


def test_pairs_find_what_single_features_miss():
    rng = np.random.default_rng(3)
    values = rng.random((4000, len(quality.FEATURES)))
    labels = ((values[:, 2] > 0.5) ^ (values[:, 5] > 0.5)).astype(float)
    model = quality.boost(values, labels)
    assert (5, 2) in model.pairs
    assert ((model.score(values) > 0.5) == labels).mean() > 0.95


def test_language_of_odd_and_plain_texts(spark):
    rng = random.Random(4)
    words = {"aa": ["katu", "mira", "solé", "vanu"], "bb": ["strof", "glänz", "brumt", "krasp"]}
    docs = [(k, " ".join(rng.choice(words[lang]) for _ in range(30)), lang, "s") for k, lang in enumerate(["aa", "bb"] * 60)]
    odd = [(500, None, "aa", "s"), (501, "", None, "s"), (502, "12 !?", "bb", "s"), (None, "KATU MIRA", None, None), (503, "x", None, None), (504, "日本", None, None)]
    frame = spark.createDataFrame(docs + odd, "doc_id long, text string, lang string, lang_score string")
    model = langid.fit(frame)
    assert sorted(model.languages) == ["aa", "bb"]
    lang, score = model.predict([d[1] for d in docs])
    assert lang == [d[2] for d in docs] and min(score) > 0.9
    found = {(r.doc_id, r.text): r for r in langid.identified(frame.drop("lang_score"), model).collect()}
    assert len(found) == len(docs + odd)
    for key in ((500, None), (501, ""), (502, "12 !?")):
        assert (found[key].lang_pred, found[key].lang_score) == ("und", 0.0)
    assert found[None, "KATU MIRA"].lang_pred == "aa"
    assert found[503, "x"].lang_pred in model.languages and 0 <= found[504, "日本"].lang_score <= 1
    empty = langid.fit(frame.limit(0))
    assert empty.predict(["any", None])[0] == ["und", "und"]
    assert langid.identified(frame.limit(0).drop("lang_score"), model).count() == 0
    with pytest.raises(ValueError):
        langid.identified(frame, model)
    assert langid.identified(frame, model, ("lang_pred", free_name(frame, "lang_score"))).count() == frame.count()


def test_bloom_false_positives_are_taken_off():
    masks = np.zeros(1 << 10, np.uint64)
    masks[:512] = 1  # half full: a quarter of unknown n-grams hit
    model = langid.Model(["aa"], masks, np.array([0.25]), langid.Settings(slots_log2=10))
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=12)) for _ in range(300)) for _ in range(5)]
    assert model.predict(texts)[1].max() < 0.05


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def edited(rng, words, edits, alphabet):
    words = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(words) + 1), rng.randrange(3)
        if kind == 0 or at == len(words):
            words.insert(at, rng.choice(alphabet))
        elif kind == 1:
            words.pop(at)
        else:
            words[at] = rng.choice(alphabet)
    return words


def test_ngrams_are_counted_in_little_memory():
    rng = random.Random(16)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(2000)) for _ in range(2000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k : k + 500]), pa.array(["x", "y"] * 250)], names=["text", "lang"]) for k in range(0, 2000, 500)]
    tracemalloc.start()
    total = sum(sum(b.column("times").to_pylist()) for b in langid.counted_ngrams(iter(batches), {"x": 0, "y": 1}))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == len(langid.ngrams(texts)[0])
    assert peak < 150e6, peak


def test_linked_is_the_edit_similarity():
    rng = random.Random(6)
    for _ in range(1500):
        a = [rng.randrange(rng.choice([3, 30])) for _ in range(rng.randint(0, 30))]
        b = edited(rng, a, rng.randint(0, 10), range(30))
        longer = max(len(a), len(b))
        expected = not longer or distance(a, b) <= int(0.2 * longer + 1e-9)
        x, y = np.array(a, np.uint32), np.array(b, np.uint32)
        assert neardup.linked(x, y) == expected
        assert (neardup.edit_similarity(x, y) >= 0.8 - 1e-12) == expected


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(7)
    alphabet = [f"w{k}" for k in range(3000)]
    texts = [[rng.choice(alphabet) for _ in range(rng.randint(1, 80))] for _ in range(60)]
    texts += [edited(rng, t, rng.randint(0, len(t) // 12), alphabet) for t in texts * 2]
    hot = [rng.choice(alphabet) for _ in range(50)]
    texts += [edited(rng, hot, 2, alphabet) for _ in range(150)]
    docs = [(k, " ".join(t)) for k, t in enumerate(texts)]
    docs += [(900 + k, docs[200][1]) for k in range(100)] + [(2000, None), (2001, ""), (2002, "!"), (2003, "?"), (2004, "!"), (None, docs[0][1]), (None, "nothing like it")]
    docs += [(3000, "first text of a repeated id"), (3000, "another text which is far from it"), (5, docs[5][1])]
    clashing = ["node", "key", "_key", "_doc", "_key_of", "_n", "row", "id", "h", "copies", "a.b"]
    frame = spark.createDataFrame([(d, t, *clashing) for d, t in docs], ["doc_id", "text", *clashing])
    words = Words().hashes([t for _, t in docs])
    root = {d: d for d, _ in docs if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(docs):
        for j, (b, y) in enumerate(docs[:i]):
            same = (x or "") == (y or "") or a == b or len(words[i]) and len(words[j]) and neardup.linked(words[i], words[j])
            if a is not None and b is not None and same:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    found = neardup.near_duplicates(frame).collect()
    assert len(found) == len(docs)
    assert all(r.class_id == find(r.doc_id) for r in found if r.doc_id is not None)
    assert sorted((r.class_id for r in found if r.doc_id is None), key=str) == sorted([find(0), None], key=str)
    kept = neardup.first_of_each(frame)
    assert kept.columns == frame.columns
    left = [r.doc_id for r in kept.collect()]
    assert all(tuple(r)[2:] == tuple(clashing) for r in kept.collect())
    assert sorted(left, key=str) == sorted([d for d in root if find(d) == d] + [None], key=str)


def replaced(rng, words, count):
    """words with others, found nowhere else, at ``count`` scattered places."""
    words = list(words)
    for at in rng.sample(range(len(words)), count):
        words[at] = f"new{rng.randrange(1 << 40)}"
    return words


@pytest.mark.parametrize("similarity, least", [(0.8, 0.95), (0.82, 0.97), (0.85, 0.99), (0.9, 0.999)])
def test_recall_of_scattered_edits(similarity, least):
    rng = random.Random(12)
    found = 0
    for _ in range(400):
        text = [f"w{rng.randrange(20000)}" for _ in range(200)]
        one, other = Words().hashes([" ".join(text), " ".join(replaced(rng, text, round(200 * (1 - similarity))))])
        assert neardup.linked(one, other)
        found += bool(set(neardup.order_minhash(one).tolist()) & set(neardup.order_minhash(other).tolist()))
    assert found >= least * 400, found


def test_scattered_edits_and_confusing_words(spark):
    rng = random.Random(13)
    texts = [[f"w{rng.randrange(20000)}" for _ in range(200)] for _ in range(60)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)] + [(100 + k, " ".join(replaced(rng, t, 36))) for k, t in enumerate(texts)]
    bits = [bin(k).count("1") & 1 for k in range(2048)]
    rows += [(500 + k, "".join(pair[b] for b in bits)) for k, pair in enumerate(("ab", "ba"))]
    found = dict(map(tuple, neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert sum(found[100 + k] == k for k in range(60)) >= 57
    assert found[500] == 500 and found[501] == 501


def test_near_duplicates_in_large_buckets_of_unlike_texts(spark):
    # Most texts share a passage and are unlike; pairs among them are alike at just above 0.8.
    rng = random.Random(9)
    alphabet = [f"w{k}" for k in range(30000)]
    passage = [rng.choice(alphabet) for _ in range(77)]
    texts = [passage + [rng.choice(alphabet) for _ in range(23)] for _ in range(80)]
    texts += [edited(rng, t[:77], 4, alphabet) + edited(rng, t[77:], 13, alphabet) for t in texts[:50]]
    words = Words().hashes([" ".join(t) for t in texts])
    sketches = [set(neardup.order_minhash(w).tolist()) for w in words]
    short = [(w >> np.uint64(32)).astype(np.uint32) for w in words]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    alike = [(a, b) for b in range(len(texts)) for a in range(b) if neardup.linked(short[a], short[b])]
    for a, b in alike:
        if sketches[a] & sketches[b]:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    found = dict(map(tuple, neardup.near_duplicates(frame).collect()))
    assert found == {k: find(k) for k in range(len(texts))}
    recalled = sum(found[a] == found[b] for a, b in alike)
    assert len(alike) >= 50 and recalled >= 0.95 * len(alike), (recalled, len(alike))


def test_linked_texts_share_one_of_their_rarest_pairs():
    rng = random.Random(14)
    order = np.unique(np.concatenate([neardup.word_pairs(np.array([a, b], np.uint32)) for a in range(30) for b in range(30)]))
    shared = 0
    for _ in range(4000):
        a = [rng.randrange(rng.choice([3, 30])) for _ in range(rng.randint(1, 40))]
        b = edited(rng, a, rng.randint(0, 8), range(30))
        x, y = np.array(a, np.uint32), np.array(b, np.uint32)
        if b and neardup.linked(x, y):
            some = np.sort(rng.sample(order.tolist(), rng.choice([0, 400, len(order)]))).astype(np.uint64)
            frequent = some, np.random.default_rng(rng.randrange(9)).permutation(len(some)) + 1
            assert set(neardup.rarest_pairs(x, frequent).tolist()) & set(neardup.rarest_pairs(y, frequent).tolist())
            shared += 1
    assert shared > 500


def test_texts_with_a_passage_in_common_are_not_all_paired(spark, monkeypatch):
    rng = random.Random(15)
    passage = [f"p{k}" for k in range(40)]
    texts = [passage + [f"w{rng.randrange(30000)}" for _ in range(60)] for _ in range(300)]
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    held, linked = [], neardup._linked
    monkeypatch.setattr(neardup, "_linked", lambda pairs, words: held.append(pairs.count()) or linked(pairs, words))
    found = dict(map(tuple, neardup.near_duplicates(frame).collect()))
    assert found == {k: k for k in range(300)}
    assert held and sum(held) < 6000, held  # of 44,850


def test_texts_that_are_mostly_one_passage_are_not_all_paired(spark, monkeypatch):
    rng = random.Random(16)
    passage = [f"p{k}" for k in range(72)]
    texts = [passage + [f"w{rng.randrange(30000)}" for _ in range(28)] for _ in range(200)]
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    held, linked = [], neardup._linked
    monkeypatch.setattr(neardup, "_linked", lambda pairs, words: held.append(pairs.count()) or linked(pairs, words))
    found = dict(map(tuple, neardup.near_duplicates(frame).collect()))
    assert found == {k: k for k in range(200)}
    assert held and sum(held) < 4000, held  # of 19,900


def test_linked_texts_share_one_of_their_rarest_words_with_room_behind_it():
    rng = random.Random(17)
    shared = 0
    for _ in range(4000):
        a = [rng.randrange(rng.choice([3, 30])) for _ in range(rng.randint(1, 40))]
        b = edited(rng, a, rng.randint(0, 8), range(30))
        x, y = np.array(a, np.uint32), np.array(b, np.uint32)
        if b and neardup.linked(x, y):
            words = np.unique(np.concatenate([neardup.labelled_words(x), neardup.labelled_words(y)]))
            some = np.sort(rng.sample(words.tolist(), rng.randint(0, len(words)))).astype(np.uint64)
            frequent = some, np.random.default_rng(rng.randrange(9)).permutation(len(some)) + 1
            one, other = (neardup.rarest_words(w, frequent).tolist() for w in (x, y))
            longer = max(len(a), len(b))
            first = next(w for w in one if w in other)
            need = longer - int((1 - neardup.SIMILARITY) * longer + 1e-9)
            assert one.index(first) <= len(a) - need and other.index(first) <= len(b) - need
            shared += 1
    assert shared > 500


def test_alignment_in_the_band_is_the_edit_distance():
    rng = random.Random(18)
    for _ in range(3000):
        a = [rng.randrange(rng.choice([2, 8])) for _ in range(rng.randint(1, 25))]
        b = edited(rng, a, rng.randint(0, 12), range(8)) or [0]
        most, exact = rng.randint(0, 25), distance(a, b)
        found = neardup._banded(np.array(a, np.uint32), np.array(b, np.uint32), most)
        assert found == exact if exact <= most else found > most


def test_words_are_hashed_in_little_memory():
    texts = [" ".join(f"word{k * j % 977}" for k in range(300)) for j in range(1200)]
    reader = Words()
    reader.hashes(texts[:1])
    tracemalloc.start()
    found = reader.hashes(texts)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(found) == 1200 and peak - held < 15_000_000, (held, peak)


def test_relation_far_leaves_no_text_between():
    rng = random.Random(10)
    seen = set()
    for _ in range(4000):
        a = [rng.randrange(40) for _ in range(rng.randint(1, 30))]
        middle = edited(rng, a, rng.randint(0, 6), range(40))
        b = edited(rng, middle, rng.randint(0, 6), range(40))
        a, middle, b = (np.array(x, np.uint32) for x in (a, middle, b))
        found = neardup.relation(a, b)
        assert neardup._quick_relation(neardup._folded(a.tobytes()), neardup._folded(b.tobytes())) == found
        seen.add(found)
        assert (found == neardup.LINKED) == neardup.linked(a, b)
        assert found != neardup.FAR or not (neardup.linked(a, middle) and neardup.linked(middle, b))
    assert seen == {neardup.FAR, neardup.NEAR, neardup.LINKED}


def test_near_duplicates_of_none(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(none).count() == 0 and neardup.first_of_each(none).count() == 0


def test_connected_parts(spark):
    rng = random.Random(8)
    edges = [(k, k + 1) for k in range(300, 420)] + [(1000, k) for k in range(1001, 1200)] + [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    edges = [e for e in edges if e[0] != e[1]]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    found = {r.node: r.root for r in neardup.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: find(x) for x in root}


@pytest.fixture(scope="module")
def segmenter():
    return pieces.Segmenter(PIECES)


def test_nbest_against_all_segmentations(segmenter):
    lattice, rng = segmenter.lattice, random.Random(9)
    parts = [*"theinga ", "  ", "é", "字", "漢", " a", "in", "▁", "\n"]
    for text in [None, ""] + ["".join(rng.choices(parts, k=rng.randint(1, 6))) for _ in range(300)]:
        marked = ("▁" + text.replace(" ", "▁")) if text else ""
        ending, scores = lattice.edges(marked), []

        def walk(at, score):
            if not at:
                scores.append(score)
            for start, weight, _ in ending[at]:
                walk(start, score + weight)

        walk(len(marked), 0.0)
        found = segmenter.nbest([text], 4)[0]
        assert [s for s, _ in found] == sorted(scores, reverse=True)[:4]
        assert len({ids for _, ids in found}) == len(found)
        assert [s for s, _ in lattice.nbest(marked, 3)] == sorted(scores, reverse=True)[:3]


def test_segments_decode_to_the_text(spark):
    texts = [None, "", " ", "a  b", "line\nline", "漢字 é \x00", "x" * 3000, "word " * 2000, "twice", "twice"]
    docs = spark.createDataFrame([(k, t, 0.5) for k, t in enumerate(texts)] + [(None, "no id", 1.0)], "doc_id long, text string, score double")
    found = pieces.decoded(pieces.segment(docs, PIECES, 3), PIECES).collect()
    for row in found:
        assert row.text == ("no id" if row.doc_id is None else texts[row.doc_id] or "")
    for doc in range(len(texts)):
        own = sorted((r.rank, r.score) for r in found if r.doc_id == doc)
        assert [r for r, _ in own] == list(range(1, len(own) + 1)) and [s for _, s in own] == sorted((s for _, s in own), reverse=True)
    assert [len(r.ids) for r in found if r.doc_id in (0, 1)] == [0, 0]
    assert pieces.segment(docs.limit(0), PIECES, 3).count() == 0
