"""Cross-tokenizer alignment: tokens of two tokenizers over the same bytes, their groups and links.

A is a byte-level BPE of the ``tokenizers`` library, B a sentencepiece model with byte fallback. The
spans that both libraries report (characters for A, bytes of the text for B) give coarse cuts; where
a character is split over several tokens, decoded bytes refine them.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.llm.shared import read, stash

A_FILE, B_FILE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Pair key: A id times this plus B id.
SPAN = 1 << 20
#: Places before a single space or line break between two characters that no tokenizer's pattern takes for white space.
GAP = re.compile(r"(?<=[^\s\x85᠎​⁠﻿])(?=[ \n][^\s\x85᠎​⁠﻿])")
#: A unit that is encoded before others, so that none of them stands at the start of a text.
GUARD = " a"
#: Units whose alignment a task remembers, links of a group that are expanded token by token, pair rows that are broadcast.
REMEMBERED, EXPANDED, BROADCAST_PAIRS = 500_000, 4096, 1_000_000


@dataclass
class Aligned:
    """Alignment of texts: numbers of tokens, groups and links (a row each), groups as text, and the distinct pairs of each text in turn."""
    totals: np.ndarray
    groups: list[str]
    n_pairs: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


def byte_level_table() -> dict[str, int]:
    """Byte of every character of a byte-level vocabulary: printable Latin-1 stands for itself, the rest is shifted to 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def refined(coarse: np.ndarray, lengths: np.ndarray) -> np.ndarray | None:
    """Byte ends of tokens: the coarse ones, but decoded lengths where these differ from the spans; None if they can't meet."""
    wrong = np.flatnonzero(np.diff(coarse, prepend=0) != lengths)
    if not len(wrong):
        return coarse
    first, last = wrong[0], wrong[-1]
    ends = coarse.copy()
    ends[first:last + 1] = (coarse[first - 1] if first else 0) + np.cumsum(lengths[first:last + 1])
    return ends if ends[last] == coarse[last] else None


class Aligner:
    """Both tokenizers, made from the contents of their files."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        of = byte_level_table()
        vocab = self.a.get_vocab(with_added_tokens=False)
        a_bytes = [b""] * (max(vocab.values(), default=-1) + 1)
        for piece, i in vocab.items():
            a_bytes[i] = bytes(of[c] for c in piece) if all(c in of for c in piece) else piece.encode()
        b_bytes = [self._piece(i) for i in range(self.b.vocab_size())]
        self.bytes = [(x, np.array([*map(len, x)], np.int64)) for x in (a_bytes, b_bytes)]
        self.names = [[np.array([f"{i}{end}" for i in range(len(x))], object) for end in ends] for x, ends in ((a_bytes, ",|"), (b_bytes, ",;"))]
        # A text may be cut at gaps if neither tokenizer has tokens over such a place, and white space is left as it is.
        pre = json.loads(a_json).get("pre_tokenizer") or {}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.cut = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                    and not any(re.search("[^\u2581]\u2581|.\n|\n.", x) for x in pieces)
                    and self._tokens("  a  b \n c\nd ") is not None)
        self._forget()

    def _forget(self) -> None:
        """No unit is known. Unit 0 stands for all without tokens."""
        self.known: dict[str, int] = {}
        self.groups, self.totals = [""], np.zeros((1, 4), np.int64)
        self.start, self.pairs, self.times = np.zeros(2, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _tokens(self, text: str) -> list[np.ndarray] | None:
        """ids and byte ends of space+text by A and by B; None if the tokens' bytes aren't that."""
        raw = b" " + text.encode()
        found, spans = self.a.encode(" " + text, add_special_tokens=False), self.b.encode(text, return_type="offset_mapping")
        out = []
        for ids, offsets, (of, lengths), shift in ((found.ids, found.offsets, self.bytes[0], 0),
                                                   (spans["ids"], spans["offsets"], self.bytes[1], 1)):
            if not ids or max(ids) >= len(of) or b"".join([of[i] for i in ids]) != raw:
                return None
            at = np.array([end for _, end in offsets], np.int64) + shift  # B's spans don't count its own space
            if len(raw) != len(text) + 1:
                code = np.frombuffer((" " + text).encode("utf-32-le"), np.uint32)
                at = np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), dtype=np.int64)[at - 1] * (at > 0)
            ids = np.array(ids, np.int64)
            ends = refined(at, lengths[ids])
            if ends is None:
                return None
            out += [ids, ends]
        return out

    def _learn(self, names: list[str]) -> None:
        """Adds the alignment of each unit to what is known; they are encoded as one text, where their gaps don't matter."""
        if len(names) > 1 and not self.cut:
            for name in names:
                self._learn([name])
            return
        names = [GUARD, *names] if self.cut else names
        found = self._tokens("".join(names)[1:])
        ends = np.cumsum([len(x.encode()) for x in names])
        if found is not None:
            ids_a, ends_a, ids_b, ends_b = found
            cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
            last = np.searchsorted(cuts, ends)  # the last group of each unit
        if found is None or last[-1] >= len(cuts) or (cuts[last] != ends).any():
            names = names[1:] if self.cut else names
            if len(names) == 1:
                self.known[names[0]] = 0
                return
            half = len(names) // 2
            self._learn(names[:half])
            self._learn(names[half:])
            return
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        n_a, n_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        end_a, end_b = np.cumsum(n_a), np.cumsum(n_b)
        # `a1,a2|b1;`: each token with what follows it, A's tokens of a group before B's
        text = np.empty(len(ids_a) + len(ids_b), object)
        place_a = np.arange(len(ids_a)) + (end_b - n_b)[group_a]
        place_b = np.arange(len(ids_b)) + end_a[group_b]
        (comma_a, bar), (comma_b, semicolon) = self.names
        text[place_a], text[place_b] = comma_a[ids_a], comma_b[ids_b]
        text[place_a[end_a - 1]], text[place_b[end_b - 1]] = bar[ids_a[end_a - 1]], semicolon[ids_b[end_b - 1]]
        text = text.tolist()
        small = n_a * n_b <= EXPANDED
        left = np.flatnonzero(small[group_a])
        each = n_b[group_a[left]]
        step = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        pairs = np.repeat(ids_a[left] * SPAN, each) + ids_b[np.repeat((end_b - n_b)[group_a[left]], each) + step]
        times, unit = np.ones(len(pairs), np.int64), np.repeat(np.searchsorted(last, group_a[left]), each)
        for g in np.flatnonzero(~small):  # a long stretch without a common cut: distinct ids, not occurrences
            (ua, ca), (ub, cb) = (np.unique(x[e[g] - n[g]:e[g]], return_counts=True) for x, e, n in ((ids_a, end_a, n_a), (ids_b, end_b, n_b)))
            pairs = np.concatenate([pairs, (ua[:, None] * SPAN + ub).ravel()])
            times = np.concatenate([times, (ca[:, None] * cb).ravel()])
            unit = np.concatenate([unit, np.full(len(ua) * len(ub), np.searchsorted(last, g))])
        if not small.all():
            order = np.argsort(unit, kind="stable")
            pairs, times, unit = pairs[order], times[order], unit[order]
        upto = np.searchsorted(unit, np.arange(len(names)), side="right")
        sums = np.stack([np.diff(np.cumsum(x)[last], prepend=0) for x in (n_a, n_b, np.ones_like(n_a), n_a * n_b)], axis=1)
        tokens = [0, *(end_a + end_b)[last].tolist()]
        self.known.update((name, len(self.groups) + k) for k, name in enumerate(names))
        self.groups += ["".join(text[tokens[k]:tokens[k + 1]])[:-1] for k in range(len(names))]
        self.totals = np.concatenate([self.totals, sums])
        self.start = np.concatenate([self.start, len(self.pairs) + upto])
        self.pairs, self.times = np.concatenate([self.pairs, pairs]), np.concatenate([self.times, times])

    def align(self, texts: list[str | None]) -> Aligned:
        """Alignment of whole texts, joined from their units (cut at gaps); zeros for a text without tokens."""
        if len(self.known) > REMEMBERED or len(self.pairs) > 8 * REMEMBERED:
            self._forget()
        split = [(GAP.split(" " + t) if self.cut else [" " + t]) if t else [] for t in texts]
        names = [name for one in split for name in one]
        if new := [name for name in dict.fromkeys(names) if name not in self.known]:
            self._learn(new)
        unit = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))
        del names
        text = np.repeat(np.arange(len(texts)), [*map(len, split)])
        fit = np.bincount(text, weights=unit == 0, minlength=len(texts)) == 0  # a unit without tokens leaves its text without
        unit, text = unit[fit[text]], text[fit[text]]
        totals = np.stack([np.bincount(text, weights=c, minlength=len(texts)) for c in self.totals[unit].T], axis=1).astype(np.int64)
        n = (self.start[1:] - self.start[:-1])[unit]
        at = np.repeat(self.start[unit] - np.cumsum(n) + n, n) + np.arange(n.sum())
        keys, back = np.unique(np.repeat(text, n) * SPAN * SPAN + self.pairs[at], return_inverse=True)
        times = np.bincount(back, weights=self.times[at], minlength=len(keys)).astype(np.int64)
        of = self.known
        groups = [";".join([self.groups[of[name]] for name in one]) if ok else "" for one, ok in zip(split, fit.tolist(), strict=True)]
        return Aligned(totals, groups, np.bincount(keys // (SPAN * SPAN), minlength=len(texts)), keys % (SPAN * SPAN), times)


ADDED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Tokenizers:
    """Contents of both files (2 MB), to be broadcast; a Python worker makes the aligner once and keeps what it knows between tasks."""

    def __init__(self, a_file: str, b_file: str):
        with open(a_file, encoding="utf-8") as a, open(b_file, "rb") as b:
            self.contents = a.read(), b.read()
        self.made: Aligner | None = None

    def aligner(self) -> Aligner:
        self.made = self.made or Aligner(*self.contents)
        return self.made


def links(docs: DataFrame, text_col: str = "text", a_file: str = A_FILE, b_file: str = B_FILE,
          keep_groups: bool = False) -> DataFrame:
    """``docs`` without the text, plus n_a, n_b, n_groups, n_links, groups_sha256, pairs (array of struct(pair, times)).

    pair is A id * 2^20 + B id. The tokenizers' files are read where the driver runs and are
    broadcast, so executors need the libraries alone. ``keep_groups`` adds the groups as text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Tokenizers(a_file, b_file))
    kept = [f for f in docs.schema.fields if f.name != text_col and f.name not in (*ADDED, "groups", "pairs")]
    new = ("n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<struct<pair: long, times: long>>"
           + (", groups string" if keep_groups else ""))
    schema = T.StructType([*kept, *T.StructType.fromDDL(new).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            aligner = shared.value.aligner()
            texts = batch.column(batch.schema.get_field_index("_text"))
            for at in range(0, batch.num_rows, 256):
                found = aligner.align(texts.slice(at, 256).to_pylist())
                out = [batch.column(batch.schema.get_field_index(f.name)).slice(at, 256) for f in kept]
                out += [pa.array(c) for c in found.totals.T]
                out.append(pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups], pa.string()))
                out.append(pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(found.n_pairs)]).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(found.pairs), pa.array(found.times)], ["pair", "times"])))
                if keep_groups:
                    out.append(pa.array(found.groups, pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return docs.select(*(F.col(f.name) for f in kept), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def pair_counts(linked: DataFrame) -> DataFrame:
    """(pair, n_docs, best) of every linked pair: in how many rows, and whether that is the most of its A id."""
    n = linked.select(F.explode("pairs").alias("p")).groupBy(F.col("p.pair").alias("pair")).agg(F.count(F.lit(1)).alias("n_docs"))
    n = stash(n.withColumn("a", F.floor(F.col("pair") / F.lit(SPAN))))
    most = n.groupBy("a").agg(F.max("n_docs").alias("most"))
    return n.join(most, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def align(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the text, plus the figures of its alignment (ADDED).

    Each text is encoded without special tokens, whole: space+text by A, the text by B, which adds
    the space itself. Byte offsets where a token of A and one of B both end cut the tokens into
    groups; all A-B pairs of a group are linked. A pair's count is the number of rows that hold it
    linked. n_best: links whose count is the highest of their A id; count_sum: counts over all
    links. A text that is null, empty, or not given back by the bytes of either tokenizer has no
    tokens: zeros, and '' as hash. Texts of any length are cut before single spaces, where no token
    goes on, and their units aligned alone; the links of a stretch without common cuts are counted by distinct
    ids. Repeated rows count and stay; columns of ``docs`` with the new names are replaced; empty in, empty out.
    """
    linked = stash(links(docs.withColumn("_row", F.monotonically_increasing_id()), text_col, **options))
    counts = stash(pair_counts(linked))
    few = counts.count() <= BROADCAST_PAIRS  # else a plain join, whose hot pairs adaptive execution splits
    found = (linked.select("_row", F.explode("pairs").alias("p")).select("_row", "p.pair", "p.times")
             .join(F.broadcast(counts) if few else counts, "pair").groupBy("_row")
             .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                  F.sum(F.col("times") * F.col("n_docs")).alias("count_sum")))
    keep = [c for c in linked.columns if c not in ("_row", "pairs", "groups_sha256")]
    return linked.drop("pairs").join(found, "_row", "left").select(
        *keep, *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")), "groups_sha256")


def query(spark, sf_dir: str) -> DataFrame:
    """op13: alignment of every document under the two tokenizers."""
    return align(read(spark, sf_dir, "documents").select("doc_id", "text"))
