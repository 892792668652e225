"""Alignment of two tokenizers, against whole texts encoded by their own libraries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from odflux.llm import alignment
from odflux.llm.queries import LLM_QUERIES, SIDE_A, SIDE_B

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

PATHS = public_tokenizers.path(SIDE_A), public_tokenizers.path(SIDE_B)


class Whole:
    """Encodes whole texts and compares ends of tokens one by one."""

    def __init__(self):
        self.a = tokenizers.Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        self.spelled = {c: b for b, c in enumerate(alignment.byte_letters())}

    def bytes_a(self, number: int) -> bytes:
        return bytes(self.spelled[c] for c in self.a.id_to_token(number))

    def bytes_b(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        if self.b.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def aligned(self, text: str | None):
        """Ids, links and groups of a text; none where it has no tokens."""
        if not text:
            return None
        ids = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        ends = []
        for side, spell in zip(ids, (self.bytes_a, self.bytes_b)):
            if b"".join(map(spell, side)) != (" " + text).encode():
                return None
            at, own = 0, []
            for number in side:
                at += len(spell(number))
                own.append(at)
            ends.append(own)
        shared = sorted(set(ends[0]) & set(ends[1]))
        links = [(ids[0][ends[0].index(e)], ids[1][ends[1].index(e)]) for e in shared]
        groups, before = [], 0
        for end in shared:
            groups.append("|".join(",".join(str(i) for i, e in zip(*side) if before < e <= end) for side in zip(ids, ends)))
            before = end
        return ids, links, ";".join(groups)

    def scored(self, rows):
        found = [(doc_id, self.aligned(text)) for doc_id, text in rows]
        counts = Counter(link for _, one in found if one for link in one[1])
        top = Counter()
        for (_, b), n in counts.items():
            top[b] = max(top[b], n)
        out = []
        for doc_id, one in found:
            if one is None:
                out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
                continue
            (a, b), links, groups = one
            best = sum(counts[link] == top[link[1]] for link in links)
            total = sum(counts[link] for link in links)
            out.append((doc_id, len(a), len(b), len(links), len(links), best, total, hashlib.sha256(groups.encode()).hexdigest()))
        return out


ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\n b", "a \nb", " a b  c", "x▁y z", "▁", "<|endoftext|> <s> <unk> <0x41>",
    "\x00 \x1c a", "漢字 かな", "👩‍👩‍👧 é é ﬁ", "don't we'll I'M", "a" * 3000, "12345 678", "ǅ ͅ ᾳ", "͸ x", "a\tb \t c", "...  ---", "﻿x ​ y",
]


def _rows(n: int = 60):
    rng = random.Random(3)
    letters = ["a", "b", "the", "ing", " ", " ", "  ", "\n", ".", ",", "é", "ß", "1", "99", "'s", "漢", "▁", " ", "🎉", "A"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    plain = [" ".join(rng.choice(["the", "cat", "Sitting", "on", "añejo", "mat."]) for _ in range(40)) for _ in range(n)]
    rows = list(enumerate([*ODD, *texts, *plain, plain[0], plain[0]]))
    return [*rows, (None, plain[1]), rows[40], rows[40]]


def _got(frame):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, frame.select(*names).collect()), key=str)


@pytest.mark.parametrize("block_bytes", [1, 700, 1 << 22])
def test_scores_equal_whole_texts(spark, block_bytes):
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _got(alignment.score_links(docs, *PATHS, block_bytes)) == sorted(Whole().scored(rows), key=str)


def test_what_a_worker_remembers_does_not_matter(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    both, whole = alignment.Aligner(*PATHS), Whole()
    texts = [t or "" for _, t in _rows(20)]
    for k in range(0, len(texts), 7):
        part = texts[k : k + 7]
        there, found = both.align(part)
        expected = [(k, one[2]) for k, one in enumerate(map(whole.aligned, part)) if one]
        assert [(int(t), g.decode()) for t, g in zip(there, found.groups(both.names))] == expected
        assert len(both.number) <= 5


def test_overlaps_cover_both_sides(spark):
    rows = _rows(20)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = Whole()
    by_id = {d: whole.aligned(t) for d, t in rows if d is not None}
    for row in alignment.align(docs.where("doc_id is not null"), *PATHS).collect():
        one = by_id[row["doc_id"]]
        if one is None:
            assert (row["a_ids"], row["b_ids"], row["overlaps"], row["groups"]) == ([], [], [], "")
            continue
        ids, _, groups = one
        assert (row["a_ids"], row["b_ids"], row["groups"]) == (*ids, groups)
        cover = []
        for side, spell in zip(ids, (whole.bytes_a, whole.bytes_b)):
            at, spans = 0, []
            for number in side:
                spans.append((at, at := at + len(spell(number))))
            cover.append(spans)
        expected = [(i, j) for i, (s, e) in enumerate(cover[0]) for j, (t, f) in enumerate(cover[1]) if s < f and t < e]
        assert [(o["a"], o["b"]) for o in row["overlaps"]] == expected


def test_the_fast_library_gives_the_same_ids():
    side = alignment.ByteLevel(PATHS[0])
    assert side.fast is not None
    stretches = [t for _, t in _rows() if t]
    assert side.encode(stretches) == [e.ids for e in side.own.encode_batch([" " + s for s in stretches], add_special_tokens=False)]


def test_very_long_texts():
    both = alignment.Aligner(*PATHS)
    texts = ["ab" * 400_000, "word " * 200_000, " " * 300_000, "x"]
    there, found = both.align(texts)
    assert there.tolist() == [0, 1, 2, 3]
    assert found.count(found.a).tolist()[3] == 1
    assert (found.count(found.a) > 0).all() and (found.n_links > 0).all()


def test_query_on_odd_documents(spark, odd_docs, no_docs, tmp_path):
    for number, docs in enumerate((odd_docs, no_docs)):
        folder = str(tmp_path / str(number))
        docs.write.parquet(f"{folder}/documents.parquet")
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        assert _got(LLM_QUERIES["op13_span_align"](spark, folder)) == sorted(Whole().scored(rows), key=str)
