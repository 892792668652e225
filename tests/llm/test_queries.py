"""The registered queries and the pipeline as they run, on odd tables, against brute force."""

from __future__ import annotations

import hashlib
import importlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from odflux.llm import pii, quality, toxicity, words
from odflux.llm.queries import LLM_QUERIES, LLM_SQL
from tests.llm.test_tables import by_first_use
from tests.llm.test_texts import by_expressions

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = ("1 AS rank", "2 AS n_words", "'x' AS spans", "'y' AS key", "3 AS part")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


@pytest.fixture(scope="module")
def folder(spark, odd_docs, odd_texts, tmp_path_factory) -> str:
    """All tables that the queries read, with nulls, ties, repeated rows and columns of clashing names."""
    root = str(tmp_path_factory.mktemp("tables"))
    names = [c for c in odd_docs.columns if c in ("doc_id", "text", "source", "n_chars")]
    odd_docs.select(*names).selectExpr("*", "'en' AS lang", *EXTRA).write.parquet(f"{root}/documents.parquet")
    labels = [(k, (None, 0, 1)[k % 3], (0, 1, None)[k % 3]) for k in range(110)] + [(None, 1, 1), (3, 0, 0), (3, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'z' AS text").write.parquet(f"{root}/labels.parquet")
    urls = [None, "", "x", "http://", "HTTP://Example.COM/en/a?b", "http://www.example.com/en/", "a://b.net/es/", "a://net/fr", "a://b.net/es/"]
    pages = [(k % 7 if k % 5 else None, u, "<p>") for k, u in enumerate(urls * 3)]
    spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS rule").write.parquet(f"{root}/pages.parquet")
    vectors = [(k, [1.0, 0.01 * k, 0.0], k % 2) for k in range(12)]
    vectors += [(20, None, 0), (21, [0.0, 0.0, 0.0], 0), (22, [1.0, None, 0.0], 0), (23, [1.0, 0.0, float("nan")], 1), (24, [1.0, 0.0, 0.0], None), (25, [1.0, 0.0, 0.0], 0)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    df.selectExpr("*", "1 AS n_links").write.parquet(f"{root}/embeddings.parquet")
    spark.createDataFrame([(k, t) for k, t in enumerate(odd_texts[:20])], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


@pytest.fixture(scope="module")
def rows(spark, folder) -> list[tuple[int | None, str | None]]:
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def got(spark, name: str, folder: str, *columns: str) -> Counter:
    found = LLM_QUERIES[name](spark, folder)
    return Counter(map(tuple, found.select(*columns).collect()))


def test_op1(spark, folder, rows):
    expected = Counter({(i, n, gone, sha(kept)): k for (i, n, gone, kept), k in by_first_use(rows).items()})
    assert got(spark, "op1_relative_parse", folder, "doc_id", "n_words", "n_removed", "kept_sha256") == expected


def test_op2(spark, folder, rows):
    expected = Counter()
    for i, text in rows:
        spans = by_expressions(text or "")
        listed = ",".join(f"{pii.BASE_KINDS[k]}:{s}:{e}" for s, k, e in spans)
        expected[i, *(sum(k == kind for _, kind, _ in spans) for k in range(4)), sha(listed)] += 1
    columns = ["doc_id", *(f"n_{k}" for k in pii.BASE_KINDS), "base_sha256"]
    assert got(spark, "op2_anchor_pii", folder, *columns) == expected


def test_op3(spark, folder, rows):
    found = LLM_QUERIES["op3_flow_reshard"](spark, folder).collect()
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected
    assert {r["law"] for r in found} == {"bytes"} and {r["grown_shard"] for r in found} == {None}
    for shard in {r["shard"] for r in found}:
        assert 0 <= shard < 16
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in found)))


def test_op4(spark, folder, rows):
    found = LLM_QUERIES["op4_temperature_mix"](spark, folder).collect()
    n = {(i, len(SPACE.findall(t or ""))) for i, t in rows}
    assert {(r["doc_id"], r["n_tokens"]) for r in found} <= n
    by_source: dict = {}
    for r in found:
        by_source.setdefault(r["source"], []).append((r["start"], r["n_tokens"]))
    for stream in by_source.values():
        with_words = sorted(x for x in stream if x[1])
        assert [s for s, _ in with_words] == np.r_[0, np.cumsum([k for _, k in with_words])[:-1]].tolist()


@pytest.mark.parametrize("name", ["op5_range_rules", "op7_int8_tiles", "op11_mask_search"])
def test_queries_with_sql(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    result = con.execute(LLM_SQL[name])
    columns = [c[0] for c in result.description]
    found, expected = got(spark, name, folder, *columns), Counter(result.fetchall())
    if name == "op5_range_rules":  # its SQL has one row for equal pages, the query one for each
        assert found.total() == con.execute("SELECT count(*) FROM pages").fetchone()[0]
        found, expected = set(found), set(expected)
    assert found == expected


def shingles(text: str | None) -> frozenset:
    found = (text or "").split()
    return frozenset(tuple(found[j : j + 5]) for j in range(max(1, len(found) - 4))) if found else frozenset()


def classes(rows) -> dict[tuple, tuple[int | None, int]]:
    """(id, text) to the least id reachable and the number of linked rows."""
    usable = sorted({r for r in rows if r[0] is not None and shingles(r[1])})
    sets = [shingles(t) for _, t in usable]
    copies = Counter(rows)
    linked = [[j for j in range(len(usable)) if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(len(usable))]
    root = [i for i, _ in usable]
    for _ in usable:
        root = [min([root[i], *(root[j] for j in linked[i])]) for i in range(len(usable))]
    found = {r: (r[0], 0) for r in rows}
    for i, row in enumerate(usable):
        found[row] = root[i], sum(copies[usable[j]] for j in linked[i])
    return found


def normalised(text: str | None) -> str | None:
    """Words by the blanks of the operators, not by those of str.split()."""
    return " ".join(SPACE.findall(text or ""))


def test_op6(spark, folder, rows):
    plain = [(i, " ".join(w.replace("\x1c", "§").replace("\x85", "¶") for w in SPACE.findall(t or ""))) for i, t in rows]
    known = classes(plain)
    expected = Counter((i, known[i, t][0]) for i, t in plain)
    assert got(spark, "op6_chosen_path", folder, "doc_id", "class_id") == expected


def test_op8(spark, folder, rows):
    found = LLM_QUERIES["op8_weak_toxicity"](spark, folder).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in rows)
    for r in found:
        name = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["held_out"] == (zlib.crc32(name.encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_op9(spark, folder, rows):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    expected = Counter()
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected[i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False))] += 1
    assert got(spark, "op9_trie_bpe", folder, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected


def measures(text: str | None) -> tuple:
    found = SPACE.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    triples = Counter(zip(found, found[1:], found[2:]))
    covered = {j + d for j in range(len(found) - 2) if triples[tuple(found[j : j + 3])] > 1 for d in range(3)}
    failed = len(found) < 50 or 100 * len(covered) > 50 * len(found)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_op10(spark, folder, rows):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    expected = Counter((i, *measures(t)) for i, t in rows)
    found = LLM_QUERIES["op10_line_crf"](spark, folder).collect()
    assert Counter(tuple(r[c] for c in columns) for r in found) == expected
    assert not any(r["kept"] and r["base_failed"] for r in found)


def test_verdicts_by_all_labellings():
    """``kept`` from the best labelling among all, on texts of few lines."""
    rng = np.random.default_rng(2)
    field = quality.Field(rng.normal(0, 1.5, len(quality.FEATURES)), rng.normal(0, 1, (2, 2)))
    texts = ["\n".join(" ".join(rng.choice(["ab", "C#", "12", "long", "$"], rng.integers(1, 30))) for _ in range(rng.integers(1, 7))) for _ in range(60)]
    found = quality.judge([t.encode() for t in texts], field)
    for k, text in enumerate(texts):
        own = words.Words([text.encode()])
        lines = quality.lines_of(own, own.hashes())
        score, n = lines.features @ field.emit, len(lines.chars)
        options = [[(m >> j) & 1 for j in range(n)] for m in range(1 << n)]
        best = max(options, key=lambda o: (sum(s for s, label in zip(score, o) if label) + sum(field.step[a, b] for a, b in zip(o, o[1:])), sum(o)))
        share = sum(c for c, label in zip(lines.chars, best) if label) / max(1, sum(len(w) for w in SPACE.findall(text)))
        assert found.content_share[k] == pytest.approx(share)
        assert found.kept[k] == (not measures(text)[5] and share >= quality.MIN_CONTENT)


def test_posterior_by_the_joint_chance():
    rng = np.random.default_rng(5)
    n = toxicity.N_VOTERS
    parent = np.array([-1] + [int(rng.integers(0, j)) for j in range(1, n)])
    model = toxicity.LabelModel(0.3, parent, rng.uniform(0.05, 0.95, (n, 2, 2)))
    votes = rng.integers(0, 2, (40, n))
    for row, found in zip(votes, model.posterior(votes)):
        joint = []
        for c, prior in ((0, 0.7), (1, 0.3)):
            chance = prior
            for j in range(n):
                fires = model.table[j][c][row[parent[j]] if parent[j] >= 0 else 0]
                chance *= fires if row[j] else 1 - fires
            joint.append(chance)
        assert found == pytest.approx(joint[1] / sum(joint))


def test_pipeline_stage_by_stage(spark, folder):
    """Each stage against brute force on what the one before it kept."""
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(pipeline.STAGES)

    def run(name, df):
        found = stages[name](spark, df, folder)
        rows = [r.asDict() for r in found.collect()]
        return rows, spark.createDataFrame([tuple(r.values()) for r in rows], found.schema)

    before = [r.asDict() for r in docs.collect()]
    kept, docs_1 = run("quality rules", docs)
    assert docs_1.columns == docs.columns
    left, given = Counter((r["doc_id"], r["text"]) for r in kept), Counter((r["doc_id"], r["text"]) for r in before)
    assert not left - given and all(not measures(t)[5] for _, t in left)
    assert left

    unique, docs_2 = run("n-gram Jaccard join", docs_1)
    known = classes([(r["doc_id"], r["text"]) for r in kept])
    expected = Counter((r["doc_id"], r["text"]) for r in kept if known[r["doc_id"], r["text"]][0] == r["doc_id"])
    assert Counter((r["doc_id"], r["text"]) for r in unique) == expected

    masked, docs_3 = run("personal data", docs_2)
    assert Counter(r["doc_id"] for r in masked) == Counter(r["doc_id"] for r in unique)
    assert all(not by_expressions(r["text"] or "") and (r["n_chars"] is None or r["n_chars"] == len(r["text"] or "")) for r in masked)

    mixed, docs_4 = run("mixing", docs_3)
    uses = Counter(r["doc_id"] for r in mixed)
    assert set(uses) == {r["doc_id"] for r in masked}
    tokens, used = Counter(), Counter()
    for table, total in ((masked, tokens), (mixed, used)):
        for r in table:
            total[r["source"]] += len(SPACE.findall(r["text"] or ""))
    longest = max(len(SPACE.findall(r["text"] or "")) for r in masked)
    assert all(tokens[s] <= used[s] <= math.ceil(pipeline.MOST_USES * tokens[s]) + longest for s in tokens)

    coded, _ = run("byte-pair encoding", docs_4)
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    expected = Counter()
    for r in mixed:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        expected[r["doc_id"], len(ids), sha(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in coded) == expected

    whole = [tuple(r) for r in pipeline.run(spark, folder).select("doc_id", "n_tokens", "ids_sha256").collect()]
    assert Counter(whole) == expected


def test_pipeline_of_no_documents(spark, folder, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []
