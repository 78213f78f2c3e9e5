"""Cross-tokenizer alignment against a version that goes byte by byte over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tripwire.llm import alignment as al

SF = "/root/testdata/sf0.001"
PIECES = ["é", "😀", "a", " ", "  ", "\n", "가", "▁", "<s>", "<|endoftext|>", "the", "don't", "\t", "\x1c", " ", "　",
          "\x85", "᠎", "1234", "ﬁ", "é", "\x00", "...", "x" * 40, "​", "中文字", "≈ç√", " word"]


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(al.A_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=al.B_FILE)
    table = al.byte_level_table()
    entry = {i: bytes(table[c] for c in piece) for piece, i in a.get_vocab(with_added_tokens=False).items() if all(c in table for c in piece)}

    def tokens(text):
        left = [(i, entry[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                 for i in b.encode(text)]
        return left, right
    return tokens


def brute(texts, tokens):
    """Per text: (n_a, n_b, groups as lists) and the links of each."""
    out = []
    for text in texts:
        left, right = tokens(text) if text else ([], [])
        raw = (" " + text).encode() if text else b""
        if b"".join(x for _, x in left) != raw or b"".join(x for _, x in right) != raw:
            left, right = [], []
        groups, i, j = [], 0, 0
        while i < len(left):
            a, b = [left[i]], [right[j]]
            i, j = i + 1, j + 1
            while (d := sum(len(x) for _, x in a) - sum(len(x) for _, x in b)):
                if d < 0:
                    a.append(left[i])
                    i += 1
                else:
                    b.append(right[j])
                    j += 1
            groups.append(([x for x, _ in a], [x for x, _ in b]))
        out.append((len(left), len(right), groups, Counter((x, y) for a, b in groups for x in a for y in b)))
    count = Counter(p for *_, links in out for p in links)
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    rows = []
    for n_a, n_b, groups, links in out:
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        rows.append((n_a, n_b, len(groups), sum(links.values()), sum(k for p, k in links.items() if count[p] == most[p[0]]),
                     sum(k * count[p] for p, k in links.items()), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return rows


def test_against_bytes(spark, encoders):
    rng = random.Random(5)
    texts = [None, "", " ", "\n", "a", "the end", "the end", "x" * 3000, "😀" * 500, "word " * 40_000]
    texts += ["".join(rng.choices(PIECES, k=rng.randrange(1, 30))) for _ in range(400)]
    rows = [(i if i % 7 else None, t, -1, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_links long, pairs string").repartition(5)
    got = al.align(df.select("doc_id", "text", "n_links")).collect()
    want = [(r[0], *w) for r, w in zip(rows, brute(texts, encoders), strict=True)]
    assert sum(w[1] > 0 for w in want) > 200
    assert sorted(((r.doc_id, *(r[c] for c in al.ADDED)) for r in got), key=repr) == sorted(want, key=repr)


def test_query(spark, encoders):
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: tuple(r[c] for c in al.ADDED) for r in al.query(spark, SF).collect()}
    want = brute([r.text for r in docs], encoders)
    assert got == {r.doc_id: w for r, w in zip(docs, want, strict=True)}


def test_plain_join_and_long_groups(spark, encoders, monkeypatch):
    """Without a broadcast, and with every group counted by distinct ids, nothing changes."""
    monkeypatch.setattr(al, "BROADCAST_PAIRS", 0)
    monkeypatch.setattr(al, "EXPANDED", 1)
    texts = ["Voilà, la première 中文字 thhedness.\nOne more", "aaaa bbbb", "Ünïcödé straße"] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted((r.doc_id, *(r[c] for c in al.ADDED)) for r in al.align(df).collect())
    assert got == [(i, *w) for i, w in enumerate(brute(texts, encoders))]


def test_what_is_known_does_not_matter(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choices(["foo", "bar,", "büro", "x\ny", "  ", "中文字", "▁"], k=rng.randrange(12))) for _ in range(300)]
    one, other = (al.Tokenizers(al.A_FILE, al.B_FILE).aligner() for _ in range(2))
    whole = one.align(texts)
    monkeypatch.setattr(al, "REMEMBERED", 3)
    other.cut = False
    for at in range(0, 300, 60):
        part = other.align(texts[at:at + 60])
        assert (part.totals == whole.totals[at:at + 60]).all() and part.groups == whole.groups[at:at + 60]


def test_spans_are_refined():
    import numpy as np
    # three tokens share a character: their spans end at its end
    assert al.refined(np.array([1, 5, 5, 5, 6]), np.array([1, 1, 1, 2, 1])).tolist() == [1, 2, 3, 5, 6]
    assert al.refined(np.array([1, 2]), np.array([1, 2])) is None


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert al.align(df).count() == 0 and al.align(df).columns == ["doc_id", *al.ADDED]
