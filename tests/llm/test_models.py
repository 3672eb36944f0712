"""Benchmark passages against brute force, URL verdicts, pseudo-likelihood, and the pipeline."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clusterkit.llm import decontaminate, lm_score, url_filter
from tests.llm import cases

SF_DIR = "/root/testdata/sf0.001"

# ---- benchmark


def least_edits(part, text):
    """Edits between ``part`` and whatever piece of the text is nearest."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(part):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_windows_within_the_budget_are_found_and_no_others():
    r = random.Random(5)
    alphabet, found = "abcdefgh ", 0
    for _ in range(150):
        item = "".join(r.choice(alphabet) for _ in range(r.choice([14, 30, 60, 96, 150])))
        index = decontaminate.Index.of([(1, item)])
        edited = list(item)
        for _ in range(r.randrange(9)):
            k = r.randrange(len(edited))
            edited[k:k + r.randrange(2)] = r.choice([[], [r.choice(alphabet)]])
        text = "".join([*(r.choice(alphabet) for _ in range(r.randrange(50))), *edited, *(r.choice(alphabet) for _ in range(40))])
        code = decontaminate.normalise(text)[0].tolist()
        want = any(least_edits(index.chars[w][:index.size[w]].tolist(), code) <= index.budget[w] for w in range(len(index.item)))
        assert bool(decontaminate.matches([text], index)) == want
        found += want
    assert found > 30


def test_a_match_stays_in_its_text():
    r = random.Random(7)
    for cut in range(1, 7):
        for size in (96, 150):
            item = "".join(r.choice("abcdefghijklmnop") for _ in range(size))
            index = decontaminate.Index.of([(1, item)])
            other = lambda: "".join(r.choice("qrstuvwxyz ") for _ in range(r.randrange(20, 60)))
            texts = [other(), item[cut:], other(), item[:-cut], other(), item[cut // 2:len(item) - (cut - cut // 2)], other()]
            got = decontaminate.matches(texts, index)
            assert {m[0] for m in got} == {1, 3, 5}, cut
            assert all(0 <= a < b <= len(texts[n]) for n, _, _, _, a, b in got)


def test_contamination_of_hard_rows(spark):
    item = cases.PROSE.strip()
    rows = [*cases.TEXTS, (30, "so it goes " * 9 + item.upper().replace(",", " --") + " and on"), (31, "nothing of it here, " * 9)]
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (None, "too short"), (3, "y" * 300)], "item_id long, text string")
    docs = cases.frame(spark, rows)
    got = decontaminate.contamination(docs, bench)
    held = {4, 5, 6, 7, 30}
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, 1) for i in held}
    one = got.filter("doc_id = 30").first()
    text = rows[-2][1]
    assert text[one.first:one["last"]].lower().startswith("the harbour") and one.edits == 0
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in rows if i not in held)
    blocks = decontaminate.contamination(docs, bench, block_chars=100)  # several scans
    assert cases.by_id(blocks.collect()) == cases.by_id(got.collect())
    assert decontaminate.contamination(cases.empty(spark), bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).count() == 0
    assert decontaminate.keep_clean(docs, bench.limit(0)).count() == len(rows)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_fragments_and_replaced_words_are_found(spark):
    """Shares of the benchmark's items found in clean text: whole, with words replaced, and as fragments."""
    r = random.Random(12)
    items = [(x.item_id, x.text) for x in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    index = decontaminate.Index.of(items)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(3, 9)))
    around = lambda: " ".join(word() for _ in range(40))

    def share(change):
        texts, changed = [], [change(text.split()) for _, text in items]
        changed = [(k, words) for k, words in enumerate(changed) if words]
        texts = [f"{around()} {' '.join(words)} {around()}" for _, words in changed]
        found = {(n, item) for n, item, *_ in decontaminate.matches(texts, index)}
        return sum((n, k) in found for n, (k, _) in enumerate(changed)) / len(changed)

    def fragment(size):
        def cut(words):
            a = r.randrange(max(1, len(words) - size + 1))
            return words[a:a + size] if len(words) >= size else None

        return cut

    def replaced(count):
        def change(words):
            for k in r.sample(range(len(words)), count):
                words[k] = word()
            return words

        return change

    assert share(lambda words: words) == 1.0
    assert share(fragment(13)) >= 0.9
    assert share(replaced(1)) >= 0.95 and share(replaced(2)) >= 0.8
    clean = [around() for _ in range(300)]
    assert not decontaminate.matches(clean, index)


def test_long_texts_are_searched_in_parts(monkeypatch):
    monkeypatch.setattr(decontaminate, "SEGMENT", 300)
    index = decontaminate.Index.of([(1, cases.PROSE)])
    for shift in range(150, 450, 17):
        text = "q" * shift + " " + cases.PROSE + "z" * 200
        assert {m[2] for m in decontaminate.matches([text], index)} == set(range(len(index.item)))


# ---- URLs

URLS = [
    ("http://a.org/x", "a.org", "/x", "org/", "allow"), ("http://ORG/", "org", "/", "org/", "allow"),
    ("http://www.EXAMPLE.org/es/1?q", "www.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/en/12#t", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://b.com/fr/", "b.com", "/fr/", "com/fr/", "allow"), ("http://b.com/de/a", "b.com", "/de/a", "com/de/", "block"),
    ("http://notorg/x", "notorg", "/x", None, None), ("http://a.org?x", "a.org", "", None, None),
    ("http://Ä.com/fr", "Ä.com", "/fr", None, None), ("no scheme", "", "", None, None), (None, "", "", None, None),
    ("", "", "", None, None), ("x://y://z/p?://", "y:", "//z/p", None, None), ("http://" + "h" * 3000 + "/" + "7" * 3000, "h" * 3000, "/" + "7" * 3000, None, None),
]


def test_hosts_paths_and_rules(spark):
    rows = [(k if k % 5 else None, u, "x") for k, (u, *_) in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = {(r.page_id, r.host, r.path, r.rule): r.verdict for r in url_filter.judge_urls(pages).collect()}
    for (i, *_), (_, host, path, rule, verdict) in zip(rows, URLS):
        assert got[i, host, path, rule] in ([verdict] if verdict else ["allow", "block"])
    assert url_filter.judge_urls(pages.limit(0)).count() == 0
    allowed = pages.filter("url LIKE '%a.org/x' OR url LIKE '%notorg%'")
    assert {r.verdict for r in url_filter.judge_urls(allowed).collect()} == {"allow"}


def test_lexical_features(spark):
    pages = spark.createDataFrame([(1, "https://a-b.c.org/x/y1?p=1&q=2#z"), (2, None)], "page_id long, url string")
    one, none = url_filter.prepared(pages).orderBy("page_id").collect()
    url = "https://a-b.c.org/x/y1?p=1&q=2#z"
    share = np.array([url.count(c) for c in set(url)]) / len(url)
    assert one.entropy == pytest.approx(-(share * np.log2(share)).sum())
    assert (one.length, one.host_depth, one.path_depth, one.hyphens, one.parameters, one.https) == (len(url), 2, 2, 1, 2, 1)
    assert (one.suffix, one.domain, one.section) == ("org", "c.org", "x") and one.digit_ratio == pytest.approx(3 / len(url))
    assert none.length == 0 and none.entropy == 0 and none.parameters == 0


def test_plan_has_no_python(spark):
    plan = url_filter.judge_urls(spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString().replace("PythonRDD", "")


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_held_out_verdicts_beat_the_more_frequent_one(spark):
    right, frequent = url_filter.held_out_accuracy(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"))
    assert right > frequent


# ---- pseudo-likelihood


@pytest.fixture(scope="module")
def prose(spark):
    r = random.Random(6)
    nouns, verbs = ["dog", "cat", "bird", "fish"], ["eats", "sees", "likes"]
    line = lambda: f"the {r.choice(nouns)} {r.choice(verbs)} a {r.choice(nouns)} . "
    return spark.createDataFrame([(k, "".join(line() for _ in range(60))) for k in range(150)], "doc_id long, text string")


def test_probabilities_sum_to_one(prose):
    vocab, net = lm_score.fit(prose)
    window = np.array([[lm_score.PAD, 5, 70, lm_score.PAD]], np.int32)
    every = np.arange(lm_score.PAD, dtype=np.int32)
    total = np.exp(net.log_probability(np.repeat(window, len(every), axis=0), every)).sum()
    assert total == pytest.approx(1, abs=1e-4)


def test_training_beats_word_frequencies_and_order_matters(spark, prose):
    r = random.Random(1)
    fresh = lm_score.fit(prose)
    before = lm_score.Network.initial(fresh[0])
    text = "the dog sees a cat . " * 40
    mixed = text.split()
    r.shuffle(mixed)
    held = spark.createDataFrame([(1, text), (2, " ".join(mixed))], "doc_id long, text string")
    trained = {x.doc_id: x.mean_log_likelihood for x in lm_score.lm_scores(held, fitted=fresh).collect()}
    plain = {x.doc_id: x.mean_log_likelihood for x in lm_score.lm_scores(held, fitted=(fresh[0], before)).collect()}
    assert trained[1] > plain[1] and trained[1] > trained[2] and plain[1] == pytest.approx(plain[2], rel=1e-5)


def test_scores_are_sums_over_words(prose):
    vocab, net = lm_score.fit(prose)
    row = prose.first()
    ids = [vocab.ids[w.encode()] for w in row.text.split()]
    around = [lm_score.PAD] * 2 + ids + [lm_score.PAD] * 2
    total = sum(net.log_probability(np.array([[around[k], around[k + 1], around[k + 3], around[k + 4]]]), np.array([i]))[0]
                for k, i in enumerate(ids))
    got = lm_score.lm_scores(prose.filter(F.col("doc_id") == row.doc_id), fitted=(vocab, net)).first()
    assert got.n_words == len(ids) and got.log_likelihood == pytest.approx(total, rel=1e-5)


def test_words_of_a_bucket_have_their_share(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "WORDS", 3)
    r = random.Random(9)
    rare = {f"w{k}ing": 1 + k % 5 for k in range(40)} | {"é": 2, "語語": 3, "x" * 100: 1}
    words = ["the"] * 300 + ["dog"] * 200 + ["cat"] * 100 + [w for w, n in rare.items() for _ in range(n)]
    r.shuffle(words)
    docs = spark.createDataFrame([(k, " ".join(words[k::7])) for k in range(7)], "doc_id long, text string")
    vocab, net = lm_score.fit(docs)
    assert len(vocab.ids) == 3
    group = lambda w: zlib.crc32(w.encode()[-2:]) % lm_score.BUCKETS

    def inside(w):
        total = sum(n for v, n in rare.items() if group(v) == group(w))
        kinds = sum(group(v) == group(w) for v in rare)
        if w in rare:
            return np.log(rare[w] / (total + kinds))
        return np.log(max(kinds, 1) / max(total + kinds, 1)) - (len(w.encode()) + 1) * np.log(257)

    texts = [docs.filter("doc_id = 3").first().text, "the w4ing dog", "the w0ing dog", "the zqxing dog", "the zq dog"]
    held = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in lm_score.lm_scores(held, fitted=(vocab, net)).collect()}
    for k, text in enumerate(texts):
        stream, _ = vocab.stream([text])
        network = sum(net.log_probability(w, t).sum() for w, t in lm_score.windows(stream))
        want = network + sum(inside(w) for w in text.split() if w.encode() not in vocab.ids)
        assert got[k].log_likelihood == pytest.approx(want, rel=1e-6)
    # Of one bucket: frequent, rare, never seen.
    assert got[1].log_likelihood > got[2].log_likelihood + 1 > got[3].log_likelihood + 10


def test_words_are_counted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "HELD_WORDS", 3)  # given to the shuffle again and again
    texts = ["a b\tA\x0bc\x0c\r\n b", "", "  ", "é É e\u00a0e é \u2028x", "one two three four one five a"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    vocab = lm_score.count_words(docs)
    want = {}
    for w in " ".join(texts).encode().lower().split():
        want[w.decode()] = want.get(w.decode(), 0) + 1
    rows = spark.read.parquet(vocab.counts).collect()
    assert {r.word: r.n for r in rows} == want and len(rows) == len(want) and vocab.words == sum(want.values())


def test_words_are_split_as_python_splits_bytes():
    texts = ["a b\tA\x0bc\x0c\r\n b", "", "  ", " \u00e9 \u00c9 e\u00a0e \u2028x\n", "\x1c\x1f x\x00y \x85"]
    words, count = lm_score.split_words(pa.array(["cut off", *texts]).slice(1))
    want = [t.encode().lower().split() for t in texts]
    assert [w.encode() for w in words.to_pylist()] == [w for t in want for w in t]
    assert count.tolist() == [len(t) for t in want]
    assert lm_score.split_words(pa.array([], pa.string()))[1].tolist() == []
    large, count = lm_score.split_words(pa.array(texts, pa.large_string()))
    assert large == words and count.tolist() == [len(t) for t in want]


def test_only_words_whose_counts_are_not_held_are_joined(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "WORDS", 3)
    monkeypatch.setattr(lm_score, "BATCH_ROWS", 2)
    r = random.Random(4)
    words = ["the"] * 300 + ["dog"] * 200 + ["cat"] * 100 + [f"w{k}ing" for k in range(40) for _ in range(1 + k % 5)]
    r.shuffle(words)
    texts = [" ".join(words[k::9]) for k in range(9)] + ["", " the  w4ing\n", "w4ing zq dog"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    net, got, joined = lm_score.fit(docs)[1], [], []
    for held, size in ((0, 1), (20, 50), (200, 1 << 23)):  # none, some and all, read in parts of some bytes
        monkeypatch.setattr(lm_score, "HELD_COUNTS", held)
        monkeypatch.setattr(lm_score, "READ_BYTES", size)
        vocab = lm_score.count_words(docs)
        read = lm_score._with_ids(docs, vocab, 2).collect()
        rare = {x.doc_id: x.rare for x in read}
        assert len({x.row for x in read}) == len(texts)
        joined.append(sum(map(len, rare.values())))
        for x in read:
            ids = np.frombuffer(x.ids, "<u2")
            assert ids.tolist() == vocab.stream([texts[x.doc_id]])[0].tolist()[2:] and x.n_words == len(ids) - 2
        got.append({x.doc_id: x.log_likelihood for x in lm_score.lm_scores(docs, fitted=(vocab, net)).collect()})
    assert joined[0] > joined[1] > joined[2] == 0
    assert got[1] == pytest.approx(got[0], rel=1e-9) and got[2] == pytest.approx(got[0], rel=1e-9)


def test_scores_of_texts_without_words(spark):
    got = lm_score.lm_scores(cases.frame(spark, [(1, ""), (2, " \n"), (3, None)])).collect()
    assert sorted((x.doc_id, x.n_words, x.log_likelihood, x.mean_log_likelihood) for x in got) == [(k, 0, 0.0, None) for k in (1, 2, 3)]


def test_blocks_of_places_change_no_step(prose, monkeypatch):
    vocab, net = lm_score.fit(prose)
    rng = np.random.default_rng(8)
    window = rng.integers(0, lm_score.PAD + 1, (300, 4)).astype(np.uint16)
    target = rng.integers(0, lm_score.PAD, 300).astype(np.uint16)
    flat, score = [], []
    for block in (7, 1024):
        monkeypatch.setattr(lm_score, "BLOCK", block)
        copy = lm_score.Network.of(net.flat(), net)
        copy.learn(window, target)
        flat.append(copy.flat())
        score.append(copy.log_probability(window, target))
    assert np.abs(flat[0] - net.flat()).max() > 0.01
    assert flat[0] == pytest.approx(flat[1], abs=1e-5) and score[0] == pytest.approx(score[1], abs=1e-4)
    far = np.array([[300.0, -300.0], [-300.0, -310.0], [0.0, -305.0]], np.float32)
    want = [0, -10 - np.log(1 + np.exp(-10) + np.exp(-5))]
    assert lm_score._log_share(far, np.array([0, 1])) == pytest.approx(want, abs=1e-5)


def test_gradient_is_that_of_the_loss(prose):
    vocab, net = lm_score.fit(prose)
    rng = np.random.default_rng(3)
    window = rng.integers(0, lm_score.PAD + 1, (40, 4)).astype(np.int32)
    target = rng.integers(0, lm_score.PAD, 40).astype(np.int32)
    start = net.log_probability(window, target).mean()
    for _ in range(20):
        net.learn(window, target)
    assert net.log_probability(window, target).mean() > start + 0.5


def test_scores_of_hard_rows(spark):
    got = lm_score.lm_scores(cases.frame(spark)).collect()
    assert sorted((str(r.doc_id), r.n_words) for r in got) == sorted((str(i), len((t or "").encode().split())) for i, t in cases.TEXTS)
    for r in got:
        assert (r.mean_log_likelihood is None) == (r.n_words == 0) and r.log_likelihood <= 0
    assert lm_score.lm_scores(cases.empty(spark)).count() == 0


# ---- pipeline


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_pipeline_against_plain_stages(spark):
    from clusterkit.llm import pii, quality
    from tests.llm.test_documents import plain_similar
    import hashlib

    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    rows = [(i, t) for i, t in rows if not any(rule.rejects(quality.Text(t)) for rule in quality.RULES)]
    stay = plain_similar(rows, 5, 0.8)  # the rule of the stage: one of each group at similarity 0.8
    rows = [(i, t) for i, t in rows if i in stay]
    index = decontaminate.Index.of([(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()])
    bad = {n for n, *_ in decontaminate.matches([t for _, t in rows], index)}
    want = {i: hashlib.sha256(pii.masked(t).encode()).hexdigest() for n, (i, t) in enumerate(rows) if n not in bad}
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert got == want and bad


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_near_copy_stage_against_plain_similarity(spark):
    from tests.llm.test_documents import plain_similar

    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect()]
    want = plain_similar(rows, 5, 0.8)
    got = [r.doc_id for r in dict(corpus_pipeline.STAGES)["simhash"](spark, documents, SF_DIR).collect()]
    assert sorted(got) == sorted(want) and len(want) < len({t for _, t in rows})


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(30)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).schema.names == docs.schema.names


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_pipeline_of_hard_rows_and_of_an_empty_table(spark, tmp_path):
    """All stages over rows with nulls, copies, long texts and clashing names, and over no rows."""
    from clusterkit.llm import pii, quality
    from tests.llm.test_documents import plain_similar
    import hashlib

    rows = [*cases.TEXTS, (40, cases.PROSE + "Write to ann.bee@example.org soon. " + "It was a long and quiet day by the sea. "),
            (41, None), (None, cases.PROSE[::-1])]
    for name, frame in (("hard", cases.frame(spark, rows)), ("empty", cases.empty(spark))):
        place = str(tmp_path / name)
        frame.write.parquet(f"{place}/documents.parquet")
        spark.createDataFrame([(1, "a passage that no text here holds, " * 4)], "item_id long, text string").write.parquet(
            f"{place}/benchmark.parquet")
        docs = spark.read.parquet(f"{place}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, place)
            assert docs.columns == frame.columns
        got = sorted((str(r.doc_id), r.decoded_sha256) for r in corpus_pipeline.run(spark, place).collect())
        if name == "empty":
            assert got == []
            continue
        good = [(i, t or "") for i, t in rows if not any(rule.rejects(quality.Text(t or "")) for rule in quality.RULES)]
        # Null ids sort last, and one of rows that repeat each other stays.
        stay = plain_similar([(1 << 60 if i is None else i, t) for i, t in good], 5, 0.8)
        kept = {(i, t) for i, t in good if (1 << 60 if i is None else i) in stay}
        assert got == sorted((str(i), hashlib.sha256(pii.masked(t).encode()).hexdigest()) for i, t in kept)
