"""The methods themselves: recall, accuracy, balance, exactness on fixtures and on the small tables."""

import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import decontaminate, graph, katz, langid, mixing, packed, queries, repeats, secrets, sharding, simhash, tokencounts, vafile
from verify import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()


# ---- search -------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    con = connect(FOLDER)
    from verify import ORACLES, QUERIES
    QUERIES[name], ORACLES[name] = queries.QUERIES[name], queries.ORACLES[name]
    try:
        ok, note = compare(spark, con, FOLDER, name)
    finally:
        del QUERIES[name], ORACLES[name]
    assert ok, note


@pytest.mark.parametrize("bits,block", [(2, 3), (6, 1000)])
def test_bounds_of_any_width_give_the_exact_answer(spark, bits, block):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet").where("vec_id < 200")
    got = {tuple(r) for r in vafile.top_k(vectors, F.col("id") % 50 == 0, 3, bits, block).collect()}
    v = {r["vec_id"]: np.floor(np.array(r["embedding"], dtype=np.float64) * 256).astype(int) for r in vectors.collect()}
    want = set()
    for q in (q for q in v if q % 50 == 0):
        best = sorted((-int(v[q] @ x), i) for i, x in v.items() if i != q)[:3]
        want |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    assert got == want


# ---- near duplicates ------------------------------------------------------------


def test_every_close_pair_shares_a_key():
    masks = simhash.block_masks()
    assert len(masks) == 35
    rng = random.Random(2)
    for _ in range(2000):
        flipped = 0
        for bit in rng.sample(range(64), 4):
            flipped |= 1 << bit
        assert any(flipped & (m % (1 << 64)) == 0 for m in masks)


@pytest.mark.parametrize("tile", [4, 4096])
def test_crowded_keys_lose_no_link(spark, tile):
    rng = random.Random(3)
    fps = set()
    for centre in (0, (1 << 64) - 1, 0x0123456789ABCDEF):
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(20), rng.randrange(1, 5))) for _ in range(60)}
    fps |= {rng.getrandbits(64) for _ in range(50)}
    fps = sorted(fps)
    root = brute.groups(fps)
    df = spark.createDataFrame([(i, i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "id long, key long, fp long")
    links = simhash.near_links(df.select("fp"), tile=tile).collect()
    assert len(links) < len(fps) ** 2 / 4
    got = {r["fp"] % (1 << 64): r["first"]["id"] for r in simhash.classes(df).collect()}
    assert [got[f] for f in fps] == root


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 400) if i % 100 != 99], "a long, b long")
    got = {r["node"]: r["root"] for r in graph.components(links).collect()}
    assert all(root == node // 100 * 100 for node, root in got.items()) and len(got) == 396


# ---- languages -------------------------------------------------------------------


def test_held_out_accuracy(spark, docs):
    got = {r["doc_id"]: r for r in queries.QUERIES["op3_langid"](spark, FOLDER).collect()}
    held = [r for r in docs if got[r["doc_id"]]["held_out"]]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) >= 0.95
    assert sum(r["rejected"] for r in got.values()) <= 0.02 * len(got)


def test_slices_count_like_the_whole(monkeypatch):
    text = "der schnelle Fluss ÜBER alle Steine " * 200
    whole = langid.subword_counts(text)
    monkeypatch.setattr(langid, "SLICE", 1000)
    assert np.abs(langid.subword_counts(text) - whole).sum() < 0.02 * whole.sum()


# ---- benchmark ---------------------------------------------------------------------


def test_recall_of_edited_items(spark, docs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy("item_id").collect()]
    index = decontaminate.Index(items)
    own = [decontaminate.words_of(t) for _, t in items]
    rng = random.Random(4)
    for share, least in ((0, 1.0), (0.1, 0.95), (0.2, 0.9)):
        texts, want = [], []
        for _ in range(300):
            i = rng.randrange(len(items))
            words, around = list(own[i]), decontaminate.words_of(docs[rng.randrange(len(docs))]["text"])
            for _ in range(int(share * len(words))):
                at, kind = rng.randrange(len(words)), rng.random()
                if kind < 0.6:
                    words[at] = b"zz%d" % rng.randrange(9999)
                elif kind < 0.8:
                    del words[at]
                else:
                    words.insert(at, b"yy%d" % rng.randrange(9999))
            at = rng.randrange(len(around) + 1)
            texts.append(b" ".join([*around[:at], *words, *around[at:]]).decode())
            want.append(i)
        found = list(index.hits(texts))
        assert np.mean([any(h["item"] == i for h in f) for f, i in zip(found, want)]) >= least
        for f, text in list(zip(found, texts))[:20]:
            for h in f:
                part = decontaminate.words_of(text)[h["start"]:h["stop"]]
                assert brute.edit_distance_within(own[h["item"]], decontaminate.words_of(text)) == h["distance"] <= 0.2 * len(own[h["item"]])
                assert brute.edit_distance_within(own[h["item"]], part) == h["distance"]


def test_all_contaminated_documents_are_found(spark, docs):
    items = [decontaminate.words_of(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    got = {r["doc_id"] for r in queries.QUERIES["op4_decontaminate"](spark, FOLDER).collect()}
    want = set()
    for r in docs:
        words = decontaminate.words_of(r["text"])
        if any(decontaminate.best_match(i, words)[0] <= int(0.2 * len(i) + 1e-9) for i in items):
            want.add(r["doc_id"])
    assert got == want and want


def test_short_and_long_items():
    rng = random.Random(6)
    word = lambda: "w%d" % rng.randrange(5000)
    items = [(0, "one two three"), (1, " ".join(word() for _ in range(400))), (2, "single")]
    index = decontaminate.Index(items)
    long = items[1][1].split()
    long[:30] = [word() for _ in range(30)]     # its beginning rewritten
    texts = ["a b one two three c", " ".join(["x"] * 7 + long + ["y"]), "nothing here", "a single word"]
    assert [[h["item"] for h in f] for f in index.hits(texts)] == [[0], [1], [], [2]]


def test_blocks_of_items_give_the_same_hits(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    one = sorted(map(str, decontaminate.contaminated(docs, items).collect()))
    kept = decontaminate.drop_contaminated(docs, items).count()
    monkeypatch.setattr(decontaminate, "item_blocks", lambda b, f=decontaminate.item_blocks: f(b, 400))
    assert sorted(map(str, decontaminate.contaminated(docs, items).collect())) == one
    assert decontaminate.drop_contaminated(docs, items).count() == kept


# ---- shards ---------------------------------------------------------------------------


def test_balance_with_a_third_in_one_group(spark):
    n = 6000
    df = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id")).alias("group"),
                               (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4000)) + 8).alias("bytes"))
    df = df.withColumn("words", F.floor(F.col("bytes") / 6))
    got = sharding.pack(df, df, 24, part_rows=100).toPandas()
    by = got.groupby("shard").agg(bytes=("bytes", "sum"), words=("words", "sum"), rows=("id", "size"), top=("slot", "max"), slots=("slot", "nunique"))
    assert len(by) == 24 and (by.top + 1 == by.rows).all() and (by.slots == by.rows).all()
    for column in ("bytes", "words", "rows"):
        assert by[column].max() / by[column].mean() < 1.05 and by[column].min() / by[column].mean() > 0.95
    # a small group stays together
    small = got[got.group != 7].groupby("group").shard.nunique()
    assert (small == 1).all()


def test_groups_stay_whole(spark):
    """Groups of 2 to 100 equal rows are never torn; one of a third of the table is."""
    rows, i = [], 0
    for g in range(2, 101):
        for _ in range(g):
            rows.append((i, g * 7919, 10 + g))
            i += 1
    rows += [(i + j, 1, 50) for j in range(3000)] + [(i + 3000 + j, 10**9 + j, 8 + j % 300) for j in range(2000)]
    df = spark.createDataFrame(rows, "id long, `group` long, bytes long").withColumn("words", F.floor(F.col("bytes") / 6))
    got = sharding.pack(df, df, 24, part_rows=100).toPandas()
    shards = got.groupby("group").shard.nunique()
    assert shards[1] > 6 and (shards.drop(1) == 1).all()
    by = got.groupby("shard").agg(bytes=("bytes", "sum"), rows=("id", "size"))
    assert len(by) == 24 and (by.max() / by.mean() < 1.05).all() and (by.min() / by.mean() > 0.95).all()


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_texts_of_the_tables_stay_whole(spark, name):
    folder = f"/root/testdata/{name}"
    got = queries.QUERIES["op5_sharding"](spark, folder).toPandas()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert {r.doc_id: r.size for r in got.itertuples(index=False)} and len(got) == len(texts)
    for r in got.to_dict("records"):
        text = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(text) + 8 and r["text_crc32"] == zlib.crc32(text) and 0 <= r["shard"] < 24
    got["text"] = got.doc_id.map(texts)
    held = got.groupby("text").agg(shards=("shard", "nunique"), size=("size", "sum"), rows=("doc_id", "size"))
    fits = held[(held["size"] * 24 <= got["size"].sum()) & (held["rows"] * 24 <= len(got))]
    assert (fits.shards == 1).all()
    by = got.groupby("shard")["size"].sum()
    assert len(by) == 24 and by.max() / by.mean() < (1.05 if name == "sf0.01" else 1.6)


# ---- repeats --------------------------------------------------------------------------


@pytest.mark.parametrize("window", [2, 5, 35])
def test_repeats_of_any_window(spark, window):
    rng = random.Random(window)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for n in range(60):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(0, 120))]
        if n % 3 == 0:
            at, a = rng.randrange(len(words) + 1), rng.randrange(30)
            words[at:at] = passage[a:a + rng.randrange(60)]
        texts.append(" ".join(words))
    texts += texts[:5] + ["a b " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    # a bitmap of 64 bits lets nearly everything through to the exact matching
    for bits in (repeats.MAP_BITS, 6):
        got = {r["keep"]: r for r in repeats.remove_repeats(df, "i", window, digest=True, bits=bits).collect()}
        want = brute.repeats(texts, window)
        assert [(got[i]["n_words"], sum(s["stop"] - s["start"] for s in got[i]["spans"]), got[i]["kept"]) for i in range(len(texts))] == want


def test_packed_arrays():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        keys = np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        assert (packed.unpack_sorted(packed.pack_sorted(keys)) == keys).all()
        parts = list(packed.by_partition(keys, 7))
        assert [a for _, a, _ in parts] + [n] == sorted({0, *[b for _, _, b in parts]}) if n else parts == []
    words = packed.word_hashes([b"a", b"b", b"c", b"a", b"b", b"c", b"a"])
    three = packed.windows(words, 3)
    assert three[0] == three[3] and three[1] == three[4] and len(set(three.tolist())) == 3


# ---- mix ------------------------------------------------------------------------------


def plain_targets(sizes, share=1.5, most=2.0):
    """Repeated sharing by weight until no target is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while left > 1e-9 and free:
        total, spare = sum(weight[s] for s in free), 0.0
        for s in list(free):
            target[s] += left * weight[s] / total
            if target[s] >= most * sizes[s]:
                spare += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                free.discard(s)
        left = spare
    return target


def test_targets_and_words_taken(spark):
    rng = random.Random(9)
    rows = []
    for s, n in (("a", 30), ("b", 900), ("c", 400), ("d", 5), ("e", 700), (None, 300), ("f", 1500)):
        rows += [(s, rng.randrange(1, 60) if rng.random() < .98 else rng.randrange(300), rng.getrandbits(62)) for _ in range(n)]
    df = spark.createDataFrame(rows, "source string, size long, hash long")
    got = mixing.copies_of(df, mixing.plan_mix(df, bin_rows=200)).groupBy("source").agg(
        F.max("target").alias("target"), F.sum(F.col("repeats") * F.col("size")).alias("taken"), F.max("repeats").alias("most"),
        F.max("source_size").alias("size")).collect()
    want = plain_targets({s: sum(r[1] for r in rows if r[0] == s) for s in {r[0] for r in rows}})
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["most"] <= 2
        assert abs(r["taken"] - r["target"]) <= 2 and r["size"] == sum(x[1] for x in rows if x[0] == r["source"])


def test_equal_rows_are_taken_n_of_m(spark):
    """A source of equal rows comes within a document of its target; reruns agree."""
    rows = [("a", 50, i) for i in range(1000)] + [("b", 50, -1)] * 1000 + [("c", 50, 5000 + i) for i in range(1000)] + [(None, 7, -2)] * 30
    df = spark.createDataFrame(rows, "source string, size long, hash long").repartition(5)

    def taken():
        mix = mixing.copies_of(df, mixing.plan_mix(df, bin_rows=200))
        return sorted(map(str, mix.groupBy("source", "hash", "repeats").count().collect())), mix.groupBy("source").agg(
            F.max("target").alias("target"), F.sum(F.col("repeats") * F.col("size")).alias("taken"), F.count("*").alias("n"), F.max("size").alias("size")).collect()

    first, sums = taken()
    assert all(abs(r["taken"] - r["target"]) <= r["size"] for r in sums) and sum(r["n"] for r in sums) == len(rows)
    assert taken()[0] == first


def test_every_source_of_the_table_comes_near_its_target(spark):
    got = queries.QUERIES["op7_mixing"](spark, "/root/testdata/sf0.01").groupBy("source").agg(
        F.max("target").alias("target"), F.sum("taken").alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) <= .01 * r["target"] for r in got)


# ---- model ----------------------------------------------------------------------------


def test_discounts_leave_mass():
    d = katz.discounts([1000, 400, 220, 140, 100, 80])
    assert d[0] == 1 and all(0 < x < 1 for x in d[1:]) and list(d[1:]) == sorted(d[1:])
    assert all(0 < x < 1 for x in katz.discounts([3, 0, 1, 0, 0, 0])[1:])


def test_model_is_normalised(docs):
    model = brute.Katz([brute.tokens(r["text"]) for r in docs if brute.fold(r["doc_id"], 7) != 2], katz.discounts)
    for h in [*list(model.after)[:3], "", "the"]:
        assert sum(model.p(h, w) for w in model.uni) + model.p(h, "\0") == pytest.approx(1)


def test_model_equals_the_plain_one(spark, docs, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK", 3000)
    model = brute.Katz([brute.tokens(r["text"]) for r in docs if brute.fold(r["doc_id"], 7) != 2], katz.discounts)
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_katz"](spark, FOLDER).collect()}
    for r in docs:
        words, own = brute.tokens(r["text"]), got[r["doc_id"]]
        base = sum(np.log10((model.uni[w] + 1) / (model.n + len(model.uni) + 1)) for w in words)
        assert own["score"] == pytest.approx(model.score(words)) and own["base_score"] == pytest.approx(base)
        assert own["n_known"] == sum(model.uni[w] > 0 for w in words) and own["train_tokens"] == model.n


# ---- tokens ---------------------------------------------------------------------------


def test_edits_equal_encoding_anew(docs, monkeypatch):
    monkeypatch.setattr(tokencounts, "LEAF", 8)
    counter = tokencounts.Counter(tokencounts._ranks(tokencounts.VOCABULARY), tokencounts.PATTERN)
    rng = random.Random(1)
    bits = ["'", " ", "  ", "l", "ll", "\n", "é", "1", "23", "!", "?!", "'re", "word", " a", "\t"]
    for n in range(1500):
        text = docs[rng.randrange(len(docs))]["text"][:rng.choice([0, 5, 60, 400, 3000])]
        if n % 2:
            text = "".join(rng.choice(bits) for _ in range(rng.randrange(200)))
        edits, at = [], 0
        for _ in range(rng.randrange(1, 6)):
            start = rng.randrange(at, len(text) + 1)
            at = min(len(text), start + rng.choice([0, 0, 1, 2, 7, 40, 500]))
            edits.append((start, at, "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 2, 5, 300 if n % 50 == 0 else 3])))))
        want = text
        for start, stop, new in reversed(edits):
            want = want[:start] + new + want[stop:]
        got, tree, _, applied = tokencounts.apply_edits(text, tokencounts.Tree.of(counter.pieces(text), counter), edits, counter)
        assert got == want and applied == len(edits) and tree.chars[1] == len(want)
        assert tree.total == len(counter.encoding.encode_ordinary(want))


def test_only_what_an_edit_touches_is_encoded_again(spark):
    text = "the quick brown fox " * 5000
    df = spark.createDataFrame([(1, text, [(50_000, 50_005, "slow"), (3, 2, None), (None, 1, "x"), (99_000, 10**6, "end")]), (2, None, None)],
                               "id long, text string, edits array<struct<start:int,stop:int,text:string>>")
    got = {r["id"]: r for r in tokencounts.with_edits(tokencounts.with_trees(df), F.col("edits")).collect()}
    new = got[1]["edited"]
    counter = tokencounts.Counter(tokencounts._ranks(tokencounts.VOCABULARY), tokencounts.PATTERN)
    assert new["text"] == text[:50_000] + "slow" + text[50_005:99_000] + "end"
    assert new["n_tokens"] == len(counter.encoding.encode_ordinary(new["text"])) and new["again"] < 5000
    assert got[2]["edited"]["n_tokens"] == 0 and got[2]["edited"]["n_edits"] == 0


# ---- secrets --------------------------------------------------------------------------


def test_weak_parts_need_their_complement(spark):
    far = "x " * 200
    texts = ["login: someone99 and nothing else", "login: someone99 key 0123456789abcdef0", f"login: someone99 {far} 0123456789abcdef0",
             "see https://host.example/a for AB12cd34EF56gh78IJ90kl", "blob AB12cd34EF56gh78IJ90kl alone",
             "a@b.example.org password = 'hunter2hunter2'"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    kinds = {r["i"]: [secrets.KINDS[s["kind"]][0] for s in r["found"]] for r in secrets.find_spans(df).collect()}
    assert kinds == {0: [], 1: ["login", "hex"], 2: ["hex"], 3: ["url", "blob"], 4: [], 5: ["mail", "assign"]}


def test_crowded_document(spark):
    text = " ".join(f"user{i}@host.example 0123456789abcdef{i:04x}" for i in range(3000))
    found = secrets.find_spans(spark.createDataFrame([(1, text)], "i long, text string")).first()["found"]
    assert len(found) == 6000 and [s["start"] for s in found] == sorted(s["start"] for s in found)
    assert all(text[s["start"]:s["stop"]].startswith("0123" if secrets.KINDS[s["kind"]][0] == "hex" else "user") for s in found)


def test_linked_spans_equal_a_double_loop(spark):
    rng = random.Random(11)
    pieces = ["login=admin", "password=hunter2", "user_name: bob", "x@y.example.com", "https://example.com/2024/some-article-title-0123456789",
              "https://example.com/a", "10.0.0.1", "abcDEF0123456789abcDEFgh", "0123456789abcdef0", "AKIA" + "B" * 16, "secret: abcdefghijkl0",
              "token=short", "plain", "é" * 30, "-" * 100]
    texts = ["https://example.com/2024/some-article-title", "login=admin password=hunter2", "token=short", None, ""]
    texts += [" ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14))) for _ in range(250)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string").repartition(4)
    got = {r["i"]: [tuple(x) for x in r["found"]] for r in secrets.find_spans(df).collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute.linked_spans(text, secrets.KINDS, secrets.BASE, secrets.REACH), text
    assert got[0] == [] and [secrets.KINDS[k][0] for _, k, _ in got[1]] == ["login", "short"] and got[2] == []
