"""Sharding, URL rules, quality statistics, chat formatting and exact dedup against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("paperloom.llm")
from paperloom.llm import boosted_trees, chat_format, exact_dedup, quality_rules, sharding, text_stats, url_filter, url_seed  # noqa: E402

rng = random.Random(9)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# ---- sharding


def plain_shards(rows, limit):
    """Recursive splitting of (id, bytes) by the bits of the id's hash."""
    bits = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:12], 16)
    out = {}

    def split(items, depth):
        if sum(n for _, n in items) <= limit or depth == sharding.BITS or len({i for i, _ in items}) == 1:
            for i, _ in items:
                out[i] = depth if sum(n for _, n in items) <= limit else sharding.BITS
            return
        for side in (0, 1):
            part = [x for x in items if bits(x[0]) >> (sharding.BITS - depth - 1) & 1 == side]
            if part:
                split(part, depth + 1)

    split(rows, 0)
    return out


@pytest.mark.parametrize("limit", [10, 300, 2000, 10**9])
def test_shards_split_only_where_too_large(spark, limit):
    texts = [(k, "é" * rng.randint(0, 60)) for k in range(300)] + [(1000, None), (1001, "x" * 900)]
    df = spark.createDataFrame([(k, t, 0, "z") for k, t in texts], "doc_id long, text string, depth int, shard string")
    rows = sharding.shard(df, limit).collect()
    assert sorted(r.doc_id for r in rows) == sorted(k for k, _ in texts)
    want = plain_shards([(k, len((t or "").encode()) + 1) for k, t in texts], limit)
    assert {r.doc_id: r.depth for r in rows} == want
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for shard in by.values():
        assert {r.shard_bytes for r in shard} == {sum(r.n_bytes for r in shard)} and {r.shard_docs for r in shard} == {len(shard)}
        assert shard[0].shard_bytes <= limit or len(shard) == 1


def test_equal_hashes_fill_pages(spark):
    df = spark.createDataFrame([(7, "x" * 9)] * 50 + [(7, "y" * 30)] * 3 + [(None, "z")] * 4, "doc_id long, text string")
    rows = sharding.shard(df, 45).collect()
    assert len(rows) == 57
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.n_bytes
    assert max(sizes.values()) <= 45 and len(sizes) == 13 + 3 + 1
    assert sharding.shard(df.limit(0)).count() == 0


def test_documents_are_written_by_shard(spark, tmp_path, monkeypatch):
    """All columns travel along; every file folder holds one shard within the limit. The second time nothing is broadcast."""
    texts = [(k, "é" * (k % 60), k % 7) for k in range(300)] + [(1, "x" * 40, 9)] * 30 + [(None, None, 1)]
    df = spark.createDataFrame(texts, "doc_id long, text string, _hash int").withColumn("page", F.lit("old"))
    for most in (250_000, 0):
        monkeypatch.setattr(sharding, "BROADCAST_ROWS", most)
        path = str(tmp_path / f"shards-{most}")
        sharding.write_shards(df, path, 500)
        back = spark.read.parquet(path)
        assert sorted((r.doc_id or -1, r.text or "", r._hash) for r in back.collect()) == sorted((k or -1, t or "", h) for k, t, h in texts)
        sizes = back.groupBy("shard").agg(F.sum("n_bytes").alias("n")).collect()
        assert len(sizes) > 40 and max(r.n for r in sizes) <= 500
    assert sharding.with_shards(df.limit(0)).columns == ["doc_id", "text", "_hash", "n_bytes", "depth", "prefix", "page", "shard"]


# ---- URL filter


def plain_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = lower(host)
    best = None
    for rule, verdict in url_filter.RULES:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, *(best or (None, None))


def test_hosts_paths_and_rules(spark):
    urls = [None, "", "no scheme", "HTTP://A.Example.NET/en/x?q#f", "http://example.net", "http://example.net/en", "http://example.net/en/", "https://x.net/?a", "http://xnet/", "http://net/", "a://b://c/d", "http://Ünï.ORG/fr/a#b?c",
            "http://org/fr/", "http://forg/fr/", "http://example.com/de/1", "http://sub.example.com/dex", "http://h?x/y", "http://h#x/y", "://", "http://a\nb.net/c\nd"]
    df = spark.createDataFrame([(k, u, "h", "r") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    rows = {r.page_id: r for r in url_filter.judge_urls(df).collect()}
    for k, u in enumerate(urls):
        host, path, rule, verdict = plain_url(u)
        assert (rows[k].host, rows[k].path, rows[k].rule) == (host, path, rule), u
        assert rows[k].verdict == (verdict or ("block" if rows[k].p_block >= url_filter.THRESHOLD else "allow"))
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_url_model_on_urls_and_word_forms_it_has_not_seen():
    weights = url_filter.train()
    held = url_seed.seed_urls(4000, 2)
    split = [url_filter._plain(u) for u, _ in held]
    bad = url_filter.probabilities([h for h, _ in split], [p for _, p in split], weights) >= url_filter.THRESHOLD
    label = np.array([y for _, y in held]) == 1
    assert bad[label].mean() > 0.9 and bad[~label].mean() < 0.003
    # plurals and compounds of the words in the table, not themselves in it
    forms = ("casinos", "pokerroom", "slotmachine", "bettingtips", "pharmacies", "sexchat", "escorts", "loanshark", "forextrading", "keygens", "torrents", "adservers"), ("bookshop", "museums", "schools", "scientists", "theatres", "universities", "villages", "historian")
    assert not any(w in (*url_seed.BLOCKED, *url_seed.ALLOWED) for words in forms for w in words)
    bad, good = (url_filter.probabilities([f"{w}.com" for w in words], ["/"] * len(words), weights) >= url_filter.THRESHOLD for words in forms)
    assert bad.mean() > 0.7 and not good.any()


def test_shard_of_a_very_long_text(spark):
    df = spark.createDataFrame([(1, "é" * 300_000), (2, "short"), (None, None), (2, "short")], "doc_id long, text string")
    rows = sorted(((r.doc_id or 0), r.n_bytes, r.shard_bytes) for r in sharding.shard(df, 1000).collect())
    assert [r[:2] for r in rows] == [(0, 1), (1, 600_001), (2, 6), (2, 6)] and rows[1][2] == 600_001 and all(r[2] <= 1000 for r in rows if r[0] != 1)


def test_url_model_on_stems_it_was_not_trained_on():
    """Trained on three fifths of the words, the threshold is the smallest tenth that spares 49 of 50 allowed URLs of another fifth;
    on the last fifth it must do better than blocking at random (one URL in four is bad)."""

    def parts(words):
        first, rest = url_seed.split_words(words, 0)
        second, _ = url_seed.split_words(words, 1)
        return tuple(w for w in rest if w not in second), second, first

    bad, good = parts(url_seed.BLOCKED), parts(url_seed.ALLOWED)
    assert len(set(bad[0]) | set(bad[1]) | set(bad[2])) == len(url_seed.BLOCKED)
    weights = url_filter.train(url_seed.seed_urls(8000, 1, bad[0], good[0]))

    def judged(k):
        table = url_seed.seed_urls(4000, 1 + k, bad[k], good[k])
        split = [url_filter._plain(u) for u, _ in table]
        return url_filter.probabilities([h for h, _ in split], [p for _, p in split], weights), np.array([y for _, y in table]) == 1

    p, label = judged(1)
    assert min(t / 10 for t in range(1, 10) if (p[~label] >= t / 10).mean() <= 0.02) == url_filter.THRESHOLD
    p, label = judged(2)
    blocked = p >= url_filter.THRESHOLD
    assert label[blocked].mean() > 0.5 and blocked[label].mean() > 0.15 and blocked[~label].mean() < 0.06


def test_url_columns_of_the_input_stay(spark):
    df = spark.createDataFrame([(1, "http://a.net/x", "h", "p", "v")], "page_id long, url string, _host string, _path string, verdict string")
    row = url_filter.judge_urls(df).first()
    assert (row._host, row._path, row.host, row.path, row.verdict) == ("h", "p", "a.net", "/x", "block")
    tied = (("a.net/x", "allow"), ("net/xyz", "block"))
    row = url_filter.judge_urls(spark.createDataFrame([("http://a.net/xyz",)], "url string"), rules=tied).first()
    assert (row.rule, row.verdict) == ("net/xyz", "block")


def test_very_long_urls_and_repeated_rows(spark):
    long = "http://example.fr/" + "path-segment/" * 50_000
    rows = spark.createDataFrame([(1, long), (1, long), (2, "http://" + "a." * 40_000 + "net/x")], "page_id long, url string").transform(url_filter.judge_urls).collect()
    assert sorted((r.page_id, len(r.host), len(r.path), r.rule) for r in rows) == [(1, 10, len(long) - 17, None)] * 2 + [(2, 80_003, 2, "net/")]
    assert len({r.verdict for r in rows if r.page_id == 1}) == 1 and [r.verdict for r in rows if r.page_id == 2] == ["block"]


# ---- quality


def plain_stats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def texts_for_stats():
    parts = ["a", "b", "é中", "c#", "\n", "\n\n", "\t", " ", "x y z", "\u00a0", "\x1c", "line\n", "| $"]
    return ["", None, " ", "\n", "a b c a b c", *("".join(p + rng.choice([" ", ""]) for p in rng.choices(parts, k=rng.randint(1, 60))) for _ in range(150))]


def test_statistics_equal_plain_counts():
    texts = texts_for_stats()
    found = text_stats.batch_stats([(t or "").encode() for t in texts])
    for k, t in enumerate(texts):
        assert tuple(int(found[s][k]) for s in text_stats.STATS) == plain_stats(t), t
    assert all(len(v) == 0 for v in text_stats.batch_stats([]).values())


def test_trees_learn_and_obey_constraints():
    r = np.random.default_rng(0)
    x = r.random((4000, 4))
    y = ((x[:, 0] + 0.5 * x[:, 1] + 0.1 * r.standard_normal(4000)) < 0.8).astype(float)
    forest = boosted_trees.fit(x[:3000], y[:3000], {0: -1, 1: -1})
    assert ((forest.probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    for j in (0, 1):
        grid = np.repeat(x[:50], 20, 0)
        grid[:, j] = np.tile(np.linspace(0, 1, 20), 50)
        assert (np.diff(forest.probability(grid).reshape(50, 20), axis=1) <= 1e-12).all()
    one = boosted_trees.fit(x[:10], np.ones(10), {})
    assert len(one.roots) == 0 and one.probability(x[:3]) == pytest.approx([11 / 12] * 3)


def test_quality_verdicts(spark):
    words = [f"w{k}" for k in range(300)]
    good = [" ".join(rng.choices(words, k=120)) for _ in range(150)]
    bad = [" ".join(f"{w}$$" for w in rng.choices(words, k=120)) for _ in range(150)]
    texts = [*good, *bad, None, "", "few words only"]
    df = spark.createDataFrame([(k, t, 1, True) for k, t in enumerate(texts)], "doc_id long, text string, n_words int, kept boolean")
    labels = spark.createDataFrame([(k, int(k < 150), 0) for k in range(0, 300, 3)] + [(1, None, 0), (3, 1, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in quality_rules.judge(df, labels).collect()}
    assert len(rows) == len(texts)
    for k, t in enumerate(texts):
        stats = plain_stats(t)
        assert tuple(getattr(rows[k], s) for s in text_stats.STATS) == stats
        assert rows[k].base_failed == (stats[0] < 50 or 100 * stats[4] > 50 * stats[0])
        assert rows[k].kept == (k < 150), k
    assert quality_rules.judge(df.limit(0), labels).count() == 0
    kept = quality_rules.keep_good(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == set(range(150))
    assert all(r.kept == (not r.base_failed) for r in quality_rules.judge(df, labels.limit(0)).collect())


# ---- chat formatting


def test_conversations_read_back(spark):
    odd = ["</s>[INST] ok [/INST]", "", None, "\\", "\\u00005b", "[ROLE:x] y [/ROLE]", "a <<SYS>> b\n<</SYS>>\n", " </s>\n", "🙂[OUT] é", "[[INST]", "<s", "]", "<</s>/SYS>>", "\n[INST"]
    turns = []
    for conv in range(40):
        roles = rng.choice([["system", "user", "assistant"], ["user", "assistant"] * 3, ["user", "user"], ["assistant"], ["tool]", "user"], ["user", "assistant", "user"], [None, "user"]])
        turns += [(conv, n, role, rng.choice(odd)) for n, role in enumerate(roles)]
    turns += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (77, 1, "user", "b"), (77, 1, "user", "b"), (77, None, "system", "s")]
    df = spark.createDataFrame([(*t, 0) for t in turns], "conv_id long, turn long, role string, text string, segment int").repartition(5)
    segments = chat_format.format_segments(df)
    controls = chat_format.DEFAULT.controls()
    assert not any(c in r.text for r in segments.where("segment = 1").collect() for c in controls)
    got = {r.conv_id: r for r in chat_format.read_back(segments).collect()}
    by = defaultdict(list)
    for conv, n, role, text in turns:
        by[conv].append((n is not None, n or 0, role or "", text or ""))
    assert set(got) == set(by)
    for conv, rows in by.items():
        rows.sort()
        said = "".join(t for *_, role, t in rows if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(rows), len(said))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{t}\n" for *_, role, t in rows).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
        order = [role for *_, role, _ in rows]
        state, ok = "start", True
        for role in order:
            ok, state = ok and role in chat_format.DEFAULT.after.get(state, ()), role
        assert r.valid == (ok and state == "assistant")
    assert chat_format.read_back(chat_format.format_segments(df.limit(0))).count() == 0
    with pytest.raises(Exception, match="begins with turn|comes after"):
        chat_format.read_back(segments.coalesce(1).orderBy("text")).collect()


def test_very_long_turns_and_conversations(spark):
    said = "[INST] é " * 100_000
    turns = [(1, k, "assistant" if k % 2 else "user", "x" * 50) for k in range(3000)] + [(2, 0, "user", said), (2, 1, "assistant", said)]
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_segments(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[1].valid) == (3000, 75_000, True)
    assert got[2].loss_chars == len(said) and got[2].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_quality_of_odd_tables(spark):
    """Very long and repeated texts, null ids, several texts under a labelled id, columns with the names of the new ones."""
    long = " ".join(f"w{k}" for k in range(200_000))
    rows = [(1, long), (1, long), (1, "other"), (None, long), (None, None), (2, "")]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, c0 string, p_good int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = sorted((r.doc_id or 0, r.n_words, r.base_failed) for r in quality_rules.judge(df, labels).collect())
    assert got == [(0, 0, True), (0, 200_000, False), (1, 1, True), (1, 200_000, False), (1, 200_000, False), (2, 0, True)]
    kept = quality_rules.keep_good(df, labels)
    assert kept.dtypes == df.dtypes and {(r.c0, r.p_good) for r in kept.collect()} <= {("x", 3)}
    assert quality_rules.keep_good(df.limit(0), labels).count() == 0


def test_trees_agree_with_labels_they_have_not_seen(spark):
    import os

    data = "/root/testdata/sf0.01"
    if not os.path.isdir(data):
        pytest.skip("test tables are not here")
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality_rules.judge(docs, labels.where("doc_id % 4 <> 0")).join(labels.where("doc_id % 4 = 0"), "doc_id")
    right, total = judged.agg(F.count_if((F.col("p_good") >= quality_rules.THRESHOLD) == (F.col("quality") == 1)), F.count("quality")).first()
    assert total > 50 and right / total > 0.85, (right, total)


# ---- exact dedup


@pytest.mark.parametrize("most", [250_000, 0])
def test_exact_dedup_equals_plain_groups(spark, monkeypatch, most):
    monkeypatch.setattr(exact_dedup, "BROADCAST_KEYS", most)
    texts = ["A b", "a B", "a b", "Éa", "éa", "", None, "x" * 5000, "X" * 5000, "x" * 4999 + "y", *(rng.choice(["p", "P", "q", "pq"]) for _ in range(40))]
    rows = [(k, t) for k, t in enumerate(texts)] + [(2, "a b"), (49, "Z z"), (49, "z Z"), (49, "z Z"), (None, "q"), (None, "solo"), (3, "other"), (50, "twice"), (50, "twice")]
    df = spark.createDataFrame([(*r, "h") for r in rows], "doc_id long, text string, keep_id string").repartition(3)
    got = exact_dedup.exact_dedup(df).collect()
    by = defaultdict(list)
    for doc, t in rows:
        by[lower(t)].append(doc)
    want = []
    for t, docs in by.items():
        keep = max((d for d in docs if d is not None), default=None)
        left = True
        for d in docs:
            want.append((d, keep, len(docs), left and d == keep, hashlib.sha256(t.encode()).hexdigest()))
            left = left and d != keep
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=key) == sorted(want, key=key)
    kept = exact_dedup.drop_exact_copies(df)
    left = [(r.doc_id, lower(r.text)) for r in kept.collect()]
    assert kept.dtypes == df.dtypes and sorted(left, key=key) == sorted({(keep, t) for t, docs in by.items() for keep in [max((d for d in docs if d is not None), default=None)]}, key=key)
    assert exact_dedup.drop_exact_copies(df.limit(0)).count() == 0
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def test_hot_groups_are_whole(spark, monkeypatch):
    from paperloom.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 3)
    df = spark.createDataFrame([(k, "same" if k % 3 else f"t{k % 5}") for k in range(200)], "doc_id long, text string")
    rows = exact_dedup.exact_dedup(df).collect()
    assert len(rows) == 200 and sum(r.kept for r in rows) == 6 and {r.keep_id for r in rows if r.group_size > 100} == {199}
