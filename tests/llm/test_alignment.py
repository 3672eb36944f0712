"""Cross-tokenizer alignment against plain loops over the tokenizers' own tokens."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from clusterkit.llm import alignment
from tests.llm import cases

public_tokenizers = pytest.importorskip("public_tokenizers")
SF_DIR = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_encoders():
    import json

    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain}
    byte.update({chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in plain)})
    entry = {i: bytes(byte[c] for c in w) for w, i in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items()}

    def piece(i):
        p = s.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    return (lambda text: [(i, entry[i]) for i in t.encode(" " + text, add_special_tokens=False).ids],
            lambda text: [(i, piece(i)) for i in s.encode(text)])


def plain_report(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each text."""
    a_of, b_of = plain_encoders()
    docs = []
    for text in texts:
        a, b = (a_of(text), b_of(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a, b = [], []
        ranges = []
        for tokens in (a, b):
            at, out = 0, []
            for i, raw in tokens:
                out.append((i, at, at + len(raw)))
                at += len(raw)
            ranges.append(out)
        links, j = [], 0
        for i, start, end in ranges[0]:
            while ranges[1][j][2] <= start:
                j += 1
            k = j
            while k < len(ranges[1]) and ranges[1][k][1] < end:
                links.append((i, ranges[1][k][0]))
                k += 1
        cuts = {e for *_, e in ranges[0]} & {e for *_, e in ranges[1]}
        groups, before = [], 0
        for cut in sorted(cuts):
            groups.append("|".join(",".join(str(i) for i, s, e in side if before <= s and e <= cut) for side in ranges))
            before = cut
        docs.append((a, b, groups, links))
    count = Counter(pair for *_, links in docs for pair in set(links))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [(len(a), len(b), len(groups), len(links), sum(count[p] == best[p[0]] for p in links),
             sum(count[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for a, b, groups, links in docs]


def report(frame):
    rows = alignment.alignment_report(frame, A, B).collect()
    return [(r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)) for r in rows]


TEXTS = ["Hello there, world!", "<|endoftext|> and <s> are text </s>", "café naïve 中文字 \U0001F600\U0001F680", "  two  spaces \n\n\ttabs ",
         "under▁score", "x" * 300, "1234567890 12 345", "a\x00b", "ﬁ ½ Ⅰ", "é", "don't we'll I'VE", None, "", " "]


def test_against_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 50)
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(TEXTS + TEXTS[:4])], "doc_id long, text string, pairs string, chunk string")
    got = dict(report(frame.coalesce(2)))
    assert [got[i] for i in range(len(got))] == plain_report(TEXTS + TEXTS[:4])
    assert got[4] == (0, 0, 0, 0, 0, 0, "") and got[0][0]


def test_cuts_on_random_ends():
    rng = random.Random(4)
    for trial in range(300):
        firsts, ends, base = [[0], [0]], [[], []], 0
        for _ in range(rng.randint(0, 4)):
            size = rng.choice([0, 1, 2, 5, 40, 200])
            for side, share in zip((0, 1), (rng.random(), rng.random())):
                inner = [x for x in range(1, size) if rng.random() < share]
                ends[side] += [base + x for x in [*inner, *([size] if size else [])]]
                firsts[side].append(len(ends[side]))
            base += size
        a, b = (np.array(x, dtype="int64") for x in ends)
        i, j = alignment.common_cuts(a, b, np.array(firsts[0]), np.array(firsts[1]))
        shared = sorted(set(ends[0]) & set(ends[1]))
        assert a[i].tolist() == shared and b[j].tolist() == shared


def test_groups_of_tokens(spark):
    frame = spark.createDataFrame([(1, "Hello there, world!"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in alignment.alignments(frame, A, B).collect()}
    a_of, b_of = plain_encoders()
    assert rows[1].a_ids == [i for i, _ in a_of("Hello there, world!")]
    assert rows[1].b_ids == [i for i, _ in b_of("Hello there, world!")]
    assert rows[1].a_ends[-1] == len(rows[1].a_ids) and rows[1].b_ends[-1] == len(rows[1].b_ids)
    assert rows[2].a_ids == rows[2].b_ends == []


def test_hard_rows(spark):
    got = sorted(report(cases.frame(spark)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    plain = plain_report([t for _, t in cases.TEXTS])
    want = sorted(((i, p) for (i, _), p in zip(cases.TEXTS, plain)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == want
    assert report(cases.empty(spark)) == []


@pytest.mark.parametrize("text", [" " * 300_000, "a" * 300_000, "\n" * 100_000 + "x", "ab" * 100_000, "é" * 100_000, "1" * 200_000])
def test_very_long_pieces(text):
    sides = alignment._sides(A, B)
    a_of, b_of = plain_encoders()
    found = alignment.align_texts([text], sides)
    assert found.a.tolist() == [i for i, _ in a_of(text)] and found.b.tolist() == [i for i, _ in b_of(text)]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_whole_table(spark):
    from clusterkit.llm.queries import op13_token_alignment

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
           for r in op13_token_alignment(spark, SF_DIR).collect()}
    assert got == dict(zip([d.doc_id for d in docs], plain_report([d.text for d in docs])))


def test_ids_of_one_text_and_what_they_spell():
    sides = alignment._sides(A, B)
    for text in ["plain words", " two  spaces\n", "naïve 漢字 🙂 <s> <|endoftext|>"]:
        assert [side.spell(side.encode(given)) for side, given in zip(sides, (" " + text, text))] == [f" {text}".encode()] * 2
    ids = alignment._tokens(["a", "", "▁b", "c d"], sides)  # B's bytes of the third are not its own
    assert [[len(x) > 0 for x in side] for side in ids] == [[True, False, False, True]] * 2


def test_links_by_counting_ends():
    marks = np.random.default_rng(3).integers(0, 2, 500)
    assert (alignment._before(marks) == [marks[:k].sum() for k in range(500)]).all()
    x = alignment.align_texts(["some unlikely wordforms, perhaps", "", "and 12345 more"], alignment._sides(A, B))
    ends = [np.cumsum(side.lengths[ids]) for side, ids in zip(alignment._sides(A, B), (x.a, x.b))]
    both = np.union1d(*ends)
    assert (x.link_a == np.searchsorted(ends[0], both)).all() and (x.link_b == np.searchsorted(ends[1], both)).all()
