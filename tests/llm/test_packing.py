import random
from collections import defaultdict

from pyspark.sql import functions as F

from lotwise.llm import packing, queries


def _naive(sizes, sources, clusters, capacity):
    """Every bin is looked at for every piece."""
    pieces = [(b, min(s, b + capacity), n) for n, s in enumerate(sizes) for b in range(0, s, capacity)]
    bins = []
    out = []
    for begin, end, n in sorted(pieces, key=lambda p: (p[0] - p[1], p[2], p[0])):
        fits = [
            (b["left"], i) for i, b in enumerate(bins)
            if b["left"] >= end - begin and not (sources[n] is not None and sources[n] in b["s"]) and not (clusters[n] is not None and clusters[n] in b["c"])
        ]
        if fits:
            at = min(fits)[1]
        else:
            at = len(bins)
            bins.append({"left": capacity, "s": set(), "c": set()})
        out.append((n, begin, end, at, capacity - bins[at]["left"]))
        bins[at]["left"] -= end - begin
        bins[at]["s"].add(sources[n])
        bins[at]["c"].add(clusters[n])
    return out


def test_shards_match_a_search_of_all_bins():
    rng = random.Random(2)
    for n in (0, 1, 30, 300):
        sizes = [rng.choice([1, 3, 17, 40, 99, 100, 101, 250]) for _ in range(n)]
        sources = [rng.choice(["a", "a", "b", "c", None]) for _ in range(n)]
        clusters = [rng.choice([*range(40), None]) for _ in range(n)]
        assert packing.pack_shard(sizes, sources, clusters, 100) == _naive(sizes, sources, clusters, 100)


def test_constraints_hold_and_every_word_is_packed_once(spark, documents, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 40)
    rng = random.Random(4)
    rows = [(i, "w " * rng.choice([1, 50, 700, 1024, 3000])) for i in range(150)]
    docs = documents(*rows, *[rows[3]] * 30, (None, "w w"), (500, None), (501, " "))
    docs = docs.withColumn("source", F.concat(F.lit("s"), F.coalesce(F.col("doc_id") % 7, F.lit(0)).cast("string")))
    got = packing.pack_texts(docs).collect()
    source = {i: f"s{i % 7}" for i, _ in rows} | {None: "s0"}
    words = {i: t.split() for i, t in rows} | {None: ["w", "w"]}
    bins, covered = defaultdict(list), defaultdict(list)
    for r in got:
        if r.doc_id in (500, 501):
            assert (r.bin_id, r.piece_begin, r.piece_end) == (None, 0, 0)
            continue
        bins[r.bin_id].append(r)
        covered[r.doc_id, r.copy].append((r.piece_begin, r.piece_end))
    assert len(covered) == 150 + 30 + 1
    for (i, _), parts in covered.items():
        parts.sort()
        assert parts[0][0] == 0 and parts[-1][1] == len(words[i]) and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
    for inside in bins.values():
        inside.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in inside:
            assert r.bin_offset == at
            at += r.piece_end - r.piece_begin
        assert at <= packing.CAPACITY
        assert len({source[r.doc_id] for r in inside}) == len(inside)
    assert len({b >> 32 for b in bins}) > 2
    assert packing.pack_texts(documents()).count() == 0


def test_query_holds_all_documents(spark, small):
    got = queries.op5_pack(spark, small)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert got.select("doc_id").distinct().count() == docs.count()
    words = {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    sums = got.groupBy("doc_id").agg(F.sum(F.col("piece_end") - F.col("piece_begin")).alias("n")).collect()
    assert all(words[r.doc_id] == r.n for r in sums)


def test_shards_begin_where_the_hash_says(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 20)
    rows = spark.range(3000).select("id", (F.col("id") % 9).alias("part"))
    got = packing._in_shards(rows, F.xxhash64("id")).withColumn("place", F.xxhash64("id"))
    got = got.withColumn("first", F.pmod(F.xxhash64("place", F.lit(1)), F.lit(20)) == 0).orderBy("place").collect()
    number = 0
    for r in got:
        number += r.first
        assert r.shard == number
    assert len(got) == 3000 and number > 50


def test_more_documents_leave_other_shards_alone(spark, documents, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 30)
    rows = [(i, "w " * (1 + i * 37 % 900)) for i in range(600)]

    def bins(frame):
        inside = defaultdict(set)
        for r in packing.pack_texts(frame.withColumn("source", F.col("doc_id").cast("string"))).collect():
            inside[r.bin_id].add((r.doc_id, r.piece))
        return {frozenset(x) for x in inside.values()}

    before, after = bins(documents(*rows)), bins(documents(*rows, (1000, "w " * 300)))
    assert before != after and len(before & after) > 0.6 * len(before)


def test_query_packs_each_shard_as_the_plain_packer(spark, small):
    """The registered query against every bin looked at for every piece, shard by shard."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "source", "text", F.xxhash64("text").alias("cluster"))
    size = {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    assert len(rows) == docs.count()
    shards = defaultdict(list)
    for r in queries.op5_pack(spark, small).where("bin_id is not null").collect():
        shards[r.bin_id >> 32].append(r)
    for number, got in shards.items():
        ids = sorted({r.doc_id for r in got}, key=lambda i: (-size[i], i))
        want = _naive([size[i] for i in ids], [rows[i].source for i in ids], [rows[i].cluster for i in ids], packing.CAPACITY)
        assert sorted((ids[n], b, e, (number << 32) + bin, at) for n, b, e, bin, at in want) == sorted(
            (r.doc_id, r.piece_begin, r.piece_end, r.bin_id, r.bin_offset) for r in got
        )
