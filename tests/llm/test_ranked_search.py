"""Ranked search, against every document scored for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from odflux.llm import ranked_search
from odflux.llm.queries import LLM_QUERIES, LLM_SQL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, k=10):
    held = [(d, Counter(terms_of(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    rows = []
    for item_id, text in items:
        scored = []
        for doc_id, own in held:
            score = 0
            for term in terms_of(text):
                if tf := own[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 100 - 75 + (75 * own.total() * n_docs) // n_terms
                    score += w * (1000000000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(rows, key=str)


def got(frame):
    return sorted(map(tuple, frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(n, seed=4):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["É", "été", "don't", "A-b", "X", "漢字"]
    weights = [1 / (k + 1) for k in range(len(words))]
    rows = [(k, " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for k in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "...  \x00"), (None, rows[3][1]), rows[5], rows[5], (None, rows[3][1])]
    items = [(k, " ".join(rng.choices(words, k=rng.randint(1, 90)))) for k in range(25)]
    items += [(100, None), (101, ""), (102, "nowhere"), (None, "w1 w1 W2"), items[0], (7, "w3 w4")]
    return rows, items


@pytest.mark.parametrize("item_bytes", [1 << 20, 900])
def test_search_equals_all_scores(spark, monkeypatch, item_bytes):
    rows, items = corpus(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    found = ranked_search.search(docs.selectExpr("*", "1 AS score", "2 AS item"), asked.selectExpr("*", "3 AS rank"), item_bytes=item_bytes)
    assert got(found) == ranked(rows, items)


def test_blocks_and_pieces_do_not_matter(monkeypatch):
    rows, items = corpus(300, 9)
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", 37)
    monkeypatch.setattr(ranked_search, "AT_ONCE", 3)
    asked = [(n, Counter(t.encode() for t in terms_of(text))) for n, (_, text) in enumerate(items)]
    number = {t: n for n, t in enumerate(sorted({t for _, own in asked for t in own}))}
    blocks, block = [], ranked_search.Postings()
    for doc_id, text in rows:
        block.add(doc_id, (text or "").encode(), number)
        if block.full():
            blocks.append(block.row().to_pylist()[0])
            block = ranked_search.Postings()
    blocks.append(block.row().to_pylist()[0])
    size = ranked_search.Corpus(sum(b["n_docs"] for b in blocks), sum(b["n_terms"] for b in blocks))
    df = Counter()
    for b in blocks:
        df.update(dict(zip(b["term"], b["df"])))
    expected = ranked(rows, list(enumerate(t for _, t in items)))
    evaluated, all_found, out = 0, 0, []
    for n, own in asked:
        item = ranked_search.Item(n, {number[t]: c * size.weight(df[number[t]]) for t, c in own.items() if number[t] in df})
        for b in blocks:
            ready = ranked_search.Block(b, size)
            evaluated += ready.rank(item, 10)
            held = [t for t in item.weights if t in ready.place]
            all_found += len(ready.masks(held)[0]) if held else 0
        out += [(n, r, None if missing else d, -s) for r, (s, missing, d) in enumerate(item.best, 1)]
    assert sorted(out, key=str) == expected
    assert evaluated < all_found  # groups below the tenth score are not evaluated


def test_masks_of_many_terms_group_equal_documents():
    number = {b"t%d" % k: k for k in range(150)}
    rng = random.Random(1)
    held = [rng.sample(range(150), rng.randint(0, 4)) + [149] * (k % 2) for k in range(80)]
    block = ranked_search.Postings()
    for k, own in enumerate(held):
        block.add(k, b" ".join(b"t%d" % t for t in own), number)
    ready = ranked_search.Block(block.row().to_pylist()[0], ranked_search.Corpus(80, 400))
    terms = sorted(ready.place)
    places, group, bits = ready.masks(terms)
    assert [sorted({terms[j] for j in np.flatnonzero(bits[g])}) for g in group] == [sorted(set(held[p])) for p in places]
    assert len(bits) == len({tuple(row) for row in bits.tolist()})


def test_terms_of_long_texts_are_cut_between_terms():
    text = ("añb " * 5000 + "x" * 3000 + "\n" + "Y-z " * 100).encode()
    for piece in (1, 7, 1000, 1 << 20):
        assert [t.decode() for some in ranked_search.terms(text, piece) for t in some] == terms_of(text.decode())


def test_lengths_do_not_overflow():
    n = np.array([0, 1, 10**9], np.int64)
    assert ranked_search.Corpus(10**11, 10**13).lengths(n).tolist() == [25 + 75 * int(k) * 10**11 // 10**13 for k in n]


@pytest.mark.parametrize("kind", ["odd", "empty", "no items"])
def test_query_on_odd_tables(spark, odd_docs, no_docs, odd_texts, tmp_path, kind):
    docs = no_docs if kind == "empty" else odd_docs
    items = [] if kind == "no items" else [(k, t) for k, t in enumerate(odd_texts[:24])] + [(1, "w1 W2 w3"), (1, "w1 W2 w3")]
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = got(LLM_QUERIES["op11_mask_search"](spark, folder))
    assert found == ranked(rows, items)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    assert sorted(con.execute(LLM_SQL["op11_mask_search"]).fetchall(), key=str) == found
