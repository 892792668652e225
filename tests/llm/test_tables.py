"""Operators across documents: repeats, resharding, mixing, URL rules, near-duplicates, vectors."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from odflux.llm import components, embedding_dedup, jaccard_join, mixing, phrase_dedup, reshard, tiles, url_rules


def by_first_use(rows: list[tuple[int | None, str | None]]) -> Counter:
    """(id, words, kept text) of every row, by a table of all phrases."""
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first: dict = {}
    for i, w in words:
        for j in range(len(w) - 12):
            if i is not None:
                phrase = tuple(w[j : j + 13])
                first[phrase] = min(first.get(phrase, i), i)
    found = Counter()
    for i, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - 12):
            if i is not None and first[tuple(w[j : j + 13])] < i:
                gone[j : j + 13] = [True] * 13
        found[i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()] += 1
    return found


@pytest.mark.parametrize("block_bytes", [2000, 4 << 20])
def test_repeats_of_odd_documents(odd_docs, monkeypatch, block_bytes):
    monkeypatch.setattr(phrase_dedup, "BLOCK_BYTES", block_bytes)
    rows = phrase_dedup.remove_repeats(odd_docs).collect()
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows)
    assert got == by_first_use([(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()])
    for row in rows:
        gone = {w for f in row["factors"] for w in range(f["start"], f["start"] + f["words"])}
        assert len(gone) == row["n_removed"] and all(f["source"] < row["doc_id"] for f in row["factors"])


def test_repeats_over_source_boundaries_and_hot_passages(spark):
    rng = random.Random(3)
    few = [f"{rng.choice('ab')}{k}" for k in range(12)]
    passage = " ".join(f"p{k}" for k in range(30))
    rows = []
    for i in range(150):
        text = " ".join(rng.choice(few[:4]) for _ in range(rng.randint(0, 90)))
        rows.append((rng.randrange(400), text if i % 3 else f"{text} {passage} {text[::-1]}"))
    rows.append((999, " ".join(f"{t}" for _, t in rows[:4])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in phrase_dedup.remove_repeats(docs).collect())
    assert got == by_first_use(rows)


def test_repeats_of_no_documents(no_docs):
    assert phrase_dedup.remove_repeats(no_docs).collect() == []


def test_min_cost_flow_against_all_transfers():
    rng = random.Random(1)
    for _ in range(60):
        supply = [rng.randint(0, 3) for _ in range(2)]
        capacity = [rng.randint(0, 3) for _ in range(3)]
        cost = [[rng.randint(0, 4) for _ in capacity] for _ in supply]
        if sum(supply) > sum(capacity):
            continue
        flow = reshard.min_cost_flow(supply, capacity, cost)
        assert [sum(r) for r in flow] == supply
        assert all(sum(c) <= m for c, m in zip(zip(*flow), capacity))
        best = min(
            sum(x * c for x, c in zip(f, sum(cost, [])))
            for f in product(range(4), repeat=6)
            if [sum(f[:3]), sum(f[3:])] == supply and all(f[j] + f[3 + j] <= capacity[j] for j in range(3))
        )
        assert sum(f * c for fr, cr in zip(flow, cost) for f, c in zip(fr, cr)) == best


def test_resharding(spark, tmp_path):
    rng = random.Random(9)
    rows = [(k, 1 + int(rng.expovariate(1 / 2000)), "x" * (k % 5), k % 3 if k % 4 else 0) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, size long, part string, old int")
    placed = reshard.reshard(docs, F.col("old"), 5, ["size"], rows_per_block=64)
    assert placed.columns == [*docs.columns, "old_shard", "shard", "slot"]
    found = placed.collect()
    assert sorted(tuple(r)[:4] for r in found) == sorted(rows)
    total, sizes, old_sizes, moved = sum(r[1] for r in rows), Counter(), Counter(), 0
    slots = defaultdict(list)
    for r in found:
        sizes[r["shard"]] += r["size"]
        old_sizes[r["old_shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        moved += r["size"] * (r["shard"] != r["old_shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * total / 5
    needed = sum(max(0, s - total // 5) for s in old_sizes.values())
    assert abs(moved - needed) < 0.01 * total
    written = reshard.rewrite_affected(docs.drop("part"), placed, str(tmp_path / "out"))
    assert written == [0, 1, 2, 3, 4]
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in back.collect()) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in found)


def test_resharding_moves_nothing_that_fits(spark, tmp_path):
    docs = spark.createDataFrame([(k, 10, k % 2) for k in range(40)], "doc_id long, size long, old int")
    placed = reshard.reshard(docs, F.col("old"), 2)
    assert placed.where("old_shard != shard").count() == 0
    assert reshard.rewrite_affected(docs, placed, str(tmp_path / "none")) == []


def test_resharding_of_odd_documents(odd_docs, no_docs):
    def sized(df):
        return df.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1))

    rows = reshard.reshard(sized(odd_docs), F.pmod(F.xxhash64("doc_id"), F.lit(2)), 4).collect()
    assert len(rows) == odd_docs.count() and all(r["part"] == "extra" for r in rows)
    assert reshard.reshard(sized(no_docs), F.lit(0), 4).collect() == []
    with pytest.raises(ValueError):
        reshard.reshard(sized(odd_docs).withColumn("slot", F.lit(1)), F.lit(0), 4)


def test_equal_rows_get_slots_of_their_own(spark):
    """Ties of id, size and hash, and rows without an id."""
    rows = [(1, "same")] * 40 + [(None, "same")] * 40 + [(k, "x" * (k % 7)) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "length(text) + 1 AS size", "crc32(text) AS crc")
    for parts in (1, 5):
        old = F.pmod(F.xxhash64("doc_id"), F.lit(3))
        found = reshard.reshard(docs.repartition(parts), old, 4, ["crc"], rows_per_block=16).collect()
        assert Counter((r["doc_id"], r["text"]) for r in found) == Counter(rows)
        for shard in range(4):
            slots = sorted(r["slot"] for r in found if r["shard"] == shard)
            assert slots == list(range(len(slots)))
        sizes = Counter()
        for r in found:
            sizes[r["shard"]] += r["size"]
        assert max(sizes.values()) - min(sizes.values()) <= 4 * max(len(t) + 1 for _, t in rows)


@pytest.fixture(scope="module")
def sources(spark):
    rng = random.Random(6)
    share = {"a": 600, "b": 200, "c": 100, "d": 60, None: 40}
    rows = [(k, " ".join("w" for _ in range(rng.randint(0, 30))), s) for k, s in enumerate(s for s, n in share.items() for _ in range(n))]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)


def entropy(parts: list[float]) -> float:
    p = np.array(parts) / sum(parts)
    return float(-(p * np.log(p)).sum())


@pytest.mark.parametrize("target", [mixing.Target(entropy=0.5), mixing.Target(entropy=1.0), mixing.Target(repetition=1.5), mixing.Target(repetition=1.0)])
def test_mixture(sources, target):
    docs = {r["doc_id"]: (r["source"], len(r["text"].split())) for r in sources.collect()}
    held = Counter()
    for source, n in docs.values():
        held[source] += n
    rows = mixing.mix(sources, target, block_docs=16).collect()
    used, uses, places = Counter(), Counter(), defaultdict(list)
    for r in rows:
        used[r["source"]] += r["mix_tokens"]
        uses[r["doc_id"], r["mix_epoch"]] += 1
        places[r["source"]].append((r["mix_epoch"], r["mix_start"], r["mix_tokens"]))
    assert set(uses.values()) == {1}
    for source, turns in places.items():  # streams have no gaps
        starts = sorted((s, n) for _, s, n in turns if n)
        assert [s for s, _ in starts] == np.r_[0, np.cumsum([n for _, n in starts])[:-1]].tolist(), source
    total, low, high = sum(held.values()), entropy(list(held.values())), np.log(len(held))
    if target.entropy is not None:
        assert abs(sum(used.values()) - total) <= 30 * len(held)
        assert entropy([used[s] for s in held]) >= low + target.entropy * (high - low) - 0.01
    else:
        assert {d for d, _ in uses} == set(docs)
        most = max(used[s] / held[s] for s in held)
        assert abs(most - target.repetition) < 0.05


def plain_exponent(shares: list[float], target: mixing.Target) -> int:
    """The exponent by trying halves in plain arithmetic."""
    h, n = entropy(shares), len(shares)

    def meets(k: int) -> bool:
        powers = [s ** (k / mixing.GRID) for s in shares]
        if target.entropy is not None:
            return entropy(powers) >= h + target.entropy * (math.log(n) - h) - 1e-12
        most = max(shares)
        return max((s / most) ** (k / mixing.GRID - 1) for s in shares) <= target.repetition * (1 + 1e-12)

    low, high = 0, mixing.GRID
    falls = target.entropy is not None
    if meets(mixing.GRID if falls else 0):
        return mixing.GRID if falls else 0
    while high - low > 1:
        middle = (low + high) // 2
        if meets(middle) == falls:
            low = middle
        else:
            high = middle
    return low if falls else high


@pytest.mark.parametrize("target", [mixing.Target(entropy=0.3), mixing.Target(entropy=0.9), mixing.Target(repetition=1.25), mixing.Target(repetition=3.0)])
def test_exponent_and_order_by_plain_recomputation(spark, target):
    rng = random.Random(12)
    rows = [(k, " ".join(["w"] * rng.randint(0, 40)), f"s{min(rng.randrange(9), rng.randrange(9))}") for k in range(250)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    n_tokens = {d: len(t.split()) for d, t, _ in rows}
    tokens, n_docs = Counter(), Counter()
    for d, _, s in rows:
        tokens[s] += n_tokens[d]
        n_docs[s] += 1
    total = sum(tokens.values())
    sources = spark.createDataFrame([(f"={s}", n_docs[s], t) for s, t in tokens.items()], "key string, n_docs long, tokens long")
    k = plain_exponent([t / total for t in tokens.values()], target)
    assert abs(mixing.exponent(sources, target) - k) <= 1
    k = mixing.exponent(sources, target)

    powers = {s: (t / total) ** (k / mixing.GRID) for s, t in tokens.items()}
    z, most = sum(powers.values()), max(tokens.values())
    whole = total if target.entropy is not None else most * z / (most / total) ** (k / mixing.GRID)
    digest = lambda *parts: hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()
    texts = {r["doc_id"]: r["h"] for r in docs.selectExpr("doc_id", "xxhash64(text) AS h").collect()}
    wanted = Counter()
    for s in tokens:
        quota = math.floor(powers[s] / z * whole + 0.5)
        n_blocks = -(-n_docs[s] // 16)
        blocks = defaultdict(list)
        for d, t, of in rows:
            if of == s:
                blocks[int(digest("mix", f"={s}", d, texts[d])[:8], 16) % n_blocks].append(d)
        for own in blocks.values():
            own.sort(key=lambda d: digest("mix", d, texts[d]))
        at = epoch = 0
        while at < quota:
            for b in sorted(blocks, key=lambda b: digest("mix", f"={s}", epoch, b)):
                for d in blocks[b]:
                    if at < quota or (epoch + 1) * tokens[s] <= quota:
                        wanted[d, epoch, at] += 1
                    at += n_tokens[d]
            epoch += 1
    got = Counter((r["doc_id"], r["mix_epoch"], r["mix_start"]) for r in mixing.mix(docs, target, block_docs=16).collect())
    assert got == wanted


def test_a_source_of_one_word_is_repeated_without_large_arrays(spark):
    rows = [(k, "w " * 100, "large") for k in range(300)] + [(1000, "one", "tiny"), (1001, "", "none"), (1002, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    mixed = mixing.mix(docs, mixing.Target(entropy=1.0)).where("source = 'tiny'")
    found = mixed.selectExpr("count(*)", "count(distinct mix_epoch)", "max(mix_epoch)", "min(mix_start)", "max(mix_start)").first()
    assert tuple(found) == (15001, 15001, 15000, 0, 15000)  # half of all 30001 tokens, rounded


def test_mixture_stays_in_the_engine(sources):
    plan = mixing.mix(sources, mixing.Target(entropy=0.5))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_mixture_of_odd_documents(odd_docs, no_docs):
    mixed = mixing.mixed_documents(odd_docs, mixing.Target(repetition=1.5))
    assert mixed.columns == odd_docs.columns
    texts = Counter((r["doc_id"], r["text"]) for r in odd_docs.collect())
    got = Counter((r["doc_id"], r["text"]) for r in mixed.collect())
    assert set(got) == set(texts) and all(got[k] >= n for k, n in texts.items())
    assert mixing.mix(no_docs, mixing.Target(entropy=0.5)).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(odd_docs, mixing.Target())


def test_url_rules_against_all_rules(spark):
    rng = random.Random(8)
    labels, ends = ["a", "b", "ab", "A", "a-b"], ["", "/", "/x", "/x/y", "/x/y/z"]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    rules = {(rng.choice(hosts).lower(), rng.choice(ends)): rng.choice(["allow", "block"]) for _ in range(50)}
    urls = [None, "", "no scheme", "http://", "://a", "x://A.b?q#f"] + [
        f"http://{rng.choice(hosts)}{rng.choice(ends)}{rng.choice(['', '?q=/x', '#x', '/'])}" for _ in range(600)
    ]
    urls += ["https://a.b/x/y"] * 400
    pages = spark.createDataFrame([(k if k % 50 else None, u, "x") for k, u in enumerate(urls)], "page_id long, url string, rule string").repartition(4)
    table = spark.createDataFrame([(h, p, v) for (h, p), v in rules.items()] + [(None, "/", "block"), ("a", None, "block")], "host string, path string, verdict string")
    wanted = Counter()
    for k, url in enumerate(urls):
        host, path = url_rules.host_and_path(url)
        fits = [(h, p) for h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
        wanted[k if k % 50 else None, host, path, "".join(best) if best else None, rules[best] if best else "allow"] += 1
    assert Counter(map(tuple, url_rules.judge_urls(pages, table).collect())) == wanted
    assert url_rules.judge_urls(pages.where("page_id < 0"), table).collect() == []
    assert {r["verdict"] for r in url_rules.judge_urls(pages, table.where("host = ''"), "block").collect()} == {"block"}


def test_url_rules_of_other_letters_and_equal_pages(spark):
    urls = ["http://BÜCHER.example.de/x/y"] * 3000 + ["http://www.BÜCHER.Example.de/x", "http://bücher.example.de/x"]
    pages = spark.createDataFrame([(1, u) for u in urls], "page_id long, url string").repartition(3)
    rules = spark.createDataFrame([("BÜCHER.example.DE", "/x", "block"), ("de", "/", "allow")], "host string, path string, verdict string")
    got = Counter((r["host"], r["rule"]) for r in url_rules.judge_urls(pages, rules).collect())
    assert got == {("bÜcher.example.de", "bÜcher.example.de/x"): 3000, ("www.bÜcher.example.de", "bÜcher.example.de/x"): 1, ("bücher.example.de", "de/"): 1}
    ties = url_rules.with_tie(pages)
    bounds = url_rules.range_bounds(ties, 16)
    assert len(bounds) > 8  # copies of one page are cut apart


def test_paths_of_one_host_are_nested():
    rng = random.Random(2)
    paths = sorted({"".join(rng.choice("ab/") for _ in range(rng.randint(0, 9))) for _ in range(400)})
    rules = url_rules.HostRules("h")
    for path in paths:
        rules.add(path, "allow")
    for _ in range(3000):
        asked = "".join(rng.choice("ab/") for _ in range(rng.randint(0, 12)))
        fits = [p for p in paths if asked.startswith(p)]
        at = rules.longest(asked)
        assert (rules.paths[at] if at >= 0 else None) == (max(fits, key=len) if fits else None)
    many = url_rules.HostRules("h")
    for k in sorted(f"/{k:06d}/" for k in range(100_000)):
        many.add(k, "block")
    assert all(many.longest(f"/{k:06d}/page") == k for k in range(100_000))


def closure(n: int, links: set[tuple[int, int]]) -> list[int]:
    root = list(range(n))
    for _ in range(n):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_components_of_a_long_path_and_stars(spark):
    rng = random.Random(2)
    links = {(k, k + 1) for k in range(60)} | {(100, 101 + k) for k in range(80)} | {(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(45)}
    wanted = closure(260, links)
    assert components.local_roots(260, *np.array(sorted(links)).T).tolist() == wanted
    df = spark.createDataFrame(sorted(links) + [(5, 5), (1, 0)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(df).collect()}
    assert got == {k: r for k, r in enumerate(wanted) if r != k}
    assert components.components(df.where("a < 0")).collect() == []


def near_by_sets(rows: list[tuple[int | None, str | None]]) -> dict:
    """Number of linked rows and least id reachable, by comparing all sets."""
    def of(text):
        words = (text or "").encode().split()
        return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()

    known = [(i, of(t)) for i, t in rows if i is not None]
    links = {
        (a, b) for a in range(len(known)) for b in range(a)
        if known[a][1] and known[b][1] and 5 * len(known[a][1] & known[b][1]) >= 4 * len(known[a][1] | known[b][1])
    }
    root = closure(len(known), links)
    least: dict = {}
    for (i, _), r in zip(known, root):
        least[r] = min(least.get(r, i), i)
    count = Counter(x for pair in links for x in pair)
    return Counter((known[k][0], least[root[k]], count[k]) for k in range(len(known)))


def test_near_texts_of_odd_documents(odd_docs, no_docs):
    rows = jaccard_join.near_texts(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in rows if r["doc_id"] is not None)
    assert got == near_by_sets([(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()])
    assert all(r["kept"] and r["n_links"] == 0 for r in rows if r["doc_id"] is None)
    assert jaccard_join.near_texts(no_docs).collect() == []
    left = jaccard_join.one_of_each(odd_docs)
    assert left.columns == odd_docs.columns
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in rows if r["kept"]}


@pytest.mark.parametrize("bucket", [4, 96])
def test_near_texts_with_large_groups(spark, monkeypatch, bucket):
    """With small buckets the group of near-copies is dense and compared in tiles."""
    monkeypatch.setattr(jaccard_join, "BUCKET", bucket)
    monkeypatch.setattr(jaccard_join, "TILE", 16)
    rng = random.Random(7)
    words = [f"w{k}" for k in range(500)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for k in range(90):
        text = list(base)
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(120)] = f"n{k}"
        rows.append((k, " ".join(text)))
    rows += [(k, rows[5][1]) for k in range(90, 100)]
    passage = " ".join(rng.choice(words) for _ in range(25))
    rows += [(k, " ".join(rng.choice(words) for _ in range(80)) + " " + passage) for k in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join.near_texts(docs).collect())
    assert got == near_by_sets(rows)


def test_sets_of_one_name_stay_apart(spark):
    rows = [(1, 5, 3, 10), (1, 6, 3, 11), (2, 5, 3, 12), (1, 5, 4, 13)]
    classes = spark.createDataFrame(rows, "key long, check long, size long, first_id long")
    found = jaccard_join.apart(classes).collect()
    assert len({r["key"] for r in found}) == 4
    assert {(r["name"], r["check"], r["size"], r["first_id"]) for r in found} == set(rows)
    assert [r["key"] for r in found if r["first_id"] == 12] == [2]


@pytest.mark.parametrize("rows", [0, 100_000])
def test_recall_when_every_bucket_is_split(spark, monkeypatch, rows):
    """Texts that share a template, so buckets are large and go through all levels; pairs just above the threshold."""
    monkeypatch.setattr(jaccard_join, "BUCKET", 8)
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", rows)
    rng = random.Random(3)
    template = [f"t{k}" for k in range(500)]
    texts = []
    for k in range(160):
        own = list(template)
        at = rng.randrange(500)
        for j in range(190):  # a stretch of its own, so that two texts share less than half of their shingles
            own[(at + j) % 500] = f"d{k}_{j}"
        texts.append(own)
        near = list(own)
        for j in rng.sample(range(500), 11):
            near[j] = f"n{k}_{j}"
        texts.append(near)
    sets = [{tuple(t[j : j + 5]) for j in range(len(t) - 4)} for t in texts]
    linked = {(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert len(linked) > 60
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r for r in jaccard_join.near_texts(docs).collect()}
    assert sum(r["n_links"] for r in found.values()) >= 0.99 * 2 * len(linked)
    met = sum(found[i]["class_id"] == found[j]["class_id"] for i, j in linked)
    print(f"found {met} of {len(linked)} pairs")
    assert met >= 0.99 * len(linked)


def test_start_coordinates_reach_the_recall():
    """Chance that a pair at the threshold shares no token at any start."""
    assert (1 - jaccard_join.THRESHOLD) ** len(jaccard_join.STARTS) < 1e-6


def test_shared_counts_in_strips(monkeypatch):
    monkeypatch.setattr(jaccard_join, "STRIP", 7)
    rng = random.Random(1)
    sets = [sorted(rng.sample(range(60), rng.randint(0, 30))) for _ in range(12)]
    first = np.r_[0, np.cumsum([len(s) for s in sets])]
    got = jaccard_join.shared_counts(np.array(sum(sets, [])), first, np.arange(5), np.arange(5, 12))
    assert got.tolist() == [[len({*a} & {*b}) for b in sets[5:]] for a in sets[:5]]


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 24))
    rows = []
    for k in range(160):
        v = centres[k % 6] + rng.normal(size=24) * rng.choice([0.0, 0.1, 0.16, 0.5])
        rows.append((k, v.astype(np.float32).tolist(), int(k % 6 > 2) if k % 40 else None))
    rows += [(k, rows[7][1], 0) for k in range(160, 175)] + [(175, [0.0] * 24, 0), (176, None, 0), (177, [float("nan")] + [1.0] * 23, 0)]
    rows += [(178, [None] + [1.0] * 23, 0), (179, [float("inf")] + [1.0] * 23, 1), (180, [], 1), (181, [2.0 * x for x in rows[7][1]], 0), (182, [1.0, 2.0], 0), (183, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)

    def good(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = set()
    for a, (_, u, x) in enumerate(rows):
        for b, (_, v, y) in enumerate(rows[:a]):
            if x is not None and x == y and good(u) and good(v) and len(u) == len(v):
                u64, v64 = np.array(u, float), np.array(v, float)
                if u64 @ v64 / np.sqrt((u64 @ u64) * (v64 @ v64)) >= 0.98:
                    links.add((a, b))
    root, count = closure(len(rows), links), Counter(x for pair in links for x in pair)
    assert len(links) > 300
    wanted = Counter((k, count[k], root[k], root[k] == k) for k in range(len(rows)))
    for tile in (16, 4096):
        got = embedding_dedup.near_vectors(df.withColumn("key", F.lit(1)), tile=tile)
        assert Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got.collect()) == wanted
    assert embedding_dedup.near_vectors(df.where("vec_id < 0")).collect() == []


def test_rounding_bound_holds():
    rng = np.random.default_rng(3)
    unit = rng.normal(size=(200, 40)) * rng.exponential(size=(200, 40))
    unit /= np.sqrt((unit**2).sum(1))[:, None]
    codes, scale, error = embedding_dedup.quantise(unit)
    product_ = (codes.astype(float) @ codes.astype(float).T) * np.outer(scale, scale)
    bound = error[:, None] + error + np.outer(error, error)
    assert (np.abs(product_ - unit @ unit.T) <= bound + 1e-12).all()


def test_every_pair_of_members_meets_in_one_piece(spark):
    members = spark.range(50).selectExpr("id % 2 AS group", "id AS member")
    sizes = members.groupBy("group").count().withColumnRenamed("count", "n")
    rows = tiles.tile_pairs(members, sizes, "member", 8).collect()
    found = defaultdict(list)
    for r in rows:
        found[r["group"], r["tile_a"], r["tile_b"]].append((r["member"], r["tile"]))
    met = Counter()
    for (_, a, b), inside in found.items():
        for m, t in inside:
            for n, u in inside:
                if m < n and (a == b or t != u):
                    met[m, n] += 1
    assert met == Counter({(m, n): 1 for m in range(50) for n in range(m + 1, 50) if m % 2 == n % 2})
