"""Operators that join: similarity, components, URL rules, benchmark windows."""

import random
import re
from collections import Counter

import pytest
from conftest import plan_of

from passagemill.llm import decontaminate, jaccard_join, urls
from passagemill.llm.components import connected_components
from passagemill.llm.jaccard_join import jaccard_join as join


def shingles(text):
    words = (text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def near(seed, groups=25):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        words = [f"g{g}w{rng.randint(0, 300)}" for _ in range(rng.choice([3, 6, 40, 200]))]
        for _ in range(rng.choice([1, 2, 3, 9])):
            own = list(words)
            for _ in range(rng.choice([0, 1, 1, 2])):
                own[rng.randrange(len(own))] = f"v{rng.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(own)))
    passage = " ".join(f"hot{i}" for i in range(12))
    rows += [(1000 + i, passage + " " + " ".join(f"d{i}w{j}" for j in range(60))) for i in range(60)]
    return rows


def expected(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return links, [find(i) for i in range(len(rows))]


@pytest.mark.parametrize("options", [{}, {"small": 3, "block": 4, "depth": 3}])
def test_classes_and_links(spark, options):
    rows = near(len(options))
    links, roots = expected(rows)
    found = join(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()
    got = {r.doc_id: (r.class_id, r.n_links, r.keep) for r in found}
    assert got == {d: (rows[roots[i]][0], links[i], roots[i] == i) for i, (d, _) in enumerate(rows)}
    assert sum(links.values()) > 50


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(300):
        own = list(words)
        for _ in range(3):
            own[rng.randrange(400)] = f"v{i}"
        rows.append((i, " ".join(own)))
    found = join(spark.createDataFrame(rows, "doc_id long, text string"), small=16, block=64).collect()
    links, roots = expected(rows)
    assert {r.doc_id: (r.class_id, r.n_links) for r in found} == {d: (rows[roots[i]][0], links[i]) for i, (d, _) in enumerate(rows)}


def test_a_common_passage_makes_no_group(spark, monkeypatch):
    """Documents of 40 own words and one passage of 60 have no link; no group of them is compared."""
    passage = " ".join(f"footer{i}" for i in range(60))
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(40)) + " " + passage) for i in range(3000)]
    rows += [(5000 + i, rows[i][1].replace(f"d{i}w7", "other")) for i in range(0, 60, 3)]  # near copies inside the crowd
    sizes = []
    compared = jaccard_join._compared

    def seen(keyed, sets, groups, *rest):
        sizes.extend(r["count"] for r in groups.groupBy("root").count().collect())
        return compared(keyed, sets, groups, *rest)

    monkeypatch.setattr(jaccard_join, "_compared", seen)
    found = {r.doc_id: r for r in join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert max(sizes) <= 64
    assert {d for d, r in found.items() if r.n_links} == {d for i in range(0, 60, 3) for d in (i, 5000 + i)}
    assert all(found[5000 + i].class_id == i for i in range(0, 60, 3))


def test_pairs_of_large_buckets_that_are_not_split_are_found(spark):
    """One pick or two, one depth: most pairs meet only in buckets of the common passage."""
    passage = " ".join(f"footer{i}" for i in range(60))
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(40)) + " " + passage) for i in range(200)]
    rows += [(5000 + i, rows[i][1].replace(f"d{i}w7 ", "other ")) for i in range(0, 200, 2)]
    rows += [(7000, rows[0][1]), (7000, rows[0][1])]
    found = join(spark.createDataFrame(rows, "doc_id long, text string"), recall=0.5, depth=1, small=8, block=16).collect()
    links, roots = expected(rows)
    assert {(r.doc_id, r.class_id, r.n_links) for r in found} == {(d, rows[roots[i]][0], links[i]) for i, (d, _) in enumerate(rows)}
    assert sum(n > 0 for n in links.values()) == 202


def test_rarest_shingles_that_many_sets_share(spark):
    """The exact way alone, in blocks: chains of sets near the threshold, all over one passage."""
    from pyspark.sql import functions as F

    rng = random.Random(21)
    rows = []
    for i in range(150):
        own = [f"w{j}" for j in range(60)] + [f"x{rng.randint(0, 3)}y{j}" for j in range(12)]
        rows.append((i, " ".join(own[: 60 + rng.randint(0, 12)])))
    rows = list({t: (i, t) for i, t in rows}.values())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = df.select("doc_id", jaccard_join.text_key(F.col("text")).alias("text_key"), "text")
    described = keyed.mapInArrow(jaccard_join._describe(3), f"doc_id long, text_key {jaccard_join._KEY}, node binary, size long, sketch array<int>, first array<long>").cache()
    weights = described.select("node", F.struct("doc_id", "text_key").alias("row"))
    for block in (8, 1000):
        edges = jaccard_join._by_rarest(keyed, weights, described, described.select("node"), 0.8, 4, block)
        name = {bytes(r.node): r.doc_id for r in described.collect()}
        root = {r.node: r.root for r in connected_components(edges.select("a", "b")).collect()}
        group = {name[bytes(k)]: name[bytes(v)] for k, v in root.items()}
        sets = {d: shingles(t) for d, t in rows}
        pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
        assert len(pairs) > 300 and all(group[a] == group[b] for a, b in pairs)


def test_members_of_large_buckets_are_one_row_each(spark, monkeypatch):
    """However many members a set is held against, it stays one row, and links to them are not repeated by bucket."""
    rng = random.Random(31)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):
        own = list(words)
        own[rng.randrange(200)] = f"v{i}"
        rows.append((i, " ".join(own)))
    agreement, stored, counts, plans = jaccard_join._agreement, jaccard_join.stored, [], {}

    def agreed(large, *rest):
        found = agreement(large, *rest)
        counts.append((large.count(), found.count()))
        return found

    def seen(df, label, **rest):
        plans.setdefault(label, []).append(plan_of(df))
        return stored(df, label, **rest)

    monkeypatch.setattr(jaccard_join, "_agreement", agreed)
    monkeypatch.setattr(jaccard_join, "stored", seen)
    found = join(spark.createDataFrame(rows, "doc_id long, text string"), small=16, block=64).collect()
    assert counts and all(one == other > 16 for one, other in counts)
    assert not any("explode(hubs)" in plan for plan in plans["agreement"])
    assert {r.class_id for r in found} == {0} and all(r.n_links == expected(rows)[0][r.doc_id] for r in found[:5])


def test_the_rarest_shingles_need_one_python_process_a_task(spark, monkeypatch):
    """Looking rows up and cutting them into shingles are stages of their own, so no task holds two processes."""
    rows = [(i, f"own{i} " * 40 + " ".join(f"footer{j}" for j in range(60))) for i in range(60)]
    stored, plans = jaccard_join.stored, {}

    def seen(df, label, **rest):
        plans.setdefault(label, []).append(plan_of(df))
        return stored(df, label, **rest)

    monkeypatch.setattr(jaccard_join, "stored", seen)
    join(spark.createDataFrame(rows, "doc_id long, text string"), depth=1, small=8, block=16).collect()
    assert all("MapInArrow" in plan and "ArrowEvalPython" not in plan for plan in plans["shingles"])
    assert plans["shingles"]


def test_nulls_repeats_and_short_texts(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "a  b"), (6, "a b c"), (7, long), (7, long), (None, long), (8, long + " x"), (None, None), (9, "z " * 200_000), (10, "z " * 200_001)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as node", "2 as size", "3 as text_key")
    found = Counter((r.doc_id, r.class_id, r.n_links, r.keep) for r in join(df).collect())
    assert found == Counter({
        (1, 1, 0, True): 1, (2, 2, 0, True): 1, (3, 3, 0, True): 1, (4, 4, 1, True): 1, (5, 4, 1, False): 1, (6, 6, 0, True): 1,
        (7, 7, 3, True): 2, (None, 7, 3, False): 1, (8, 7, 3, False): 1, (None, None, 0, True): 1, (9, 9, 1, True): 1, (10, 9, 1, False): 1,
    })
    assert join(df.filter("doc_id > 100")).collect() == []


def test_sketches_of_small_sets_are_exact():
    assert jaccard_join.SKETCH >= 48
    import math

    bound = 0.8 - 4.5 * math.sqrt(0.16 / jaccard_join.SKETCH)
    assert 0.5 < bound < 0.8


@pytest.mark.parametrize("n", [0, 1, 60])
def test_components(spark, n):
    rng = random.Random(n)
    edges = [(i, i + 1) for i in range(n)] + [(1000 + rng.randint(0, 40), 1000 + rng.randint(0, 40)) for _ in range(n // 2)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert {r.node: r.root for r in found} == want and len(found) == len(want)


# --- URLs ---------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "://", "http://", "http://EXAMPLE.com", "http://example.com/", "http://example.com/en", "http://example.com/en/", "http://example.com/EN/x",
    "https://www.example.com/en/1?x=http://net/es/", "http://a.www.example.com/en/#f", "http://notexample.com/en/", "ftp://x.net/es/", "http://net/fr/a/b/c",
    "http://x.net/es", "http://x.net?/es/", "http://x.net:80/es/", "a://b://c/d", "http://ÀÉ.com/", "http://example.com./en/", "http://.com/", "http://com//en/",
    "http://" + "a." * 3000 + "net/fr/" + "b/" * 3000, "http://x.net/fr/", "http://x.net/fr/", "http://example.com\n/en/",
]


def judged(url, rules=urls.RULES):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, "allow", None))
    return host, path, best[2], best[1]


def test_url_rules(spark):
    rows = list(enumerate(URLS)) + [(None, "http://x.com/"), (3, "http://x.com/")]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'a' as host", "'b' as path", "'c' as rule")
    found = urls.url_filter(df)
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found.collect())
    assert got == Counter((i, *judged(u)) for i, u in rows)
    assert not re.search("Python|Arrow|Pandas", found._jdf.queryExecution().executedPlan().toString())


def test_other_rules(spark):
    rules = [("b.c", "/", "allow"), ("c", "/x/", "block"), ("b.c", "/", "block"), ("b.c", "/x/y/", "allow")]
    df = spark.createDataFrame([(1, "http://a.b.c/x/y/z"), (2, "http://a.b.c/x/"), (3, "http://c/x/"), (4, "http://d/")], "page_id long, url string")
    assert [(r.rule, r.verdict) for r in urls.url_filter(df, rules, default="block").orderBy("page_id").collect()] == [("b.c/x/y/", "allow"), ("c/x/", "block"), ("c/x/", "block"), (None, "block")]
    with pytest.raises(ValueError):
        urls.url_filter(df, [("c", "/x", "block")])
    assert urls.url_filter(df.filter("page_id > 9")).collect() == []
    assert {r.verdict for r in urls.url_filter(df, []).collect()} == {"allow"}


# --- benchmark windows --------------------------------------------------------------------


def contaminated(rows, items, window):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wanted = {}
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - window + 1)) if w else ():
            wanted.setdefault(tuple(w[a : a + window]), set()).add(i)
    out = []
    for d, t in rows:
        w = words(t)
        hit, ids = [0] * len(w), set()
        for n in {len(x) for x in wanted}:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in wanted:
                    ids |= wanted[tuple(w[a : a + n])]
                    hit[a : a + n] = [1] * n
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((d, len(w), sum(hit), tuple(ids), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_contamination(spark, limit):
    rng = random.Random(limit)
    words = ["The", "the", "a", "É1", "x-y", "☃", "rare", "zz9"]
    rows = [(rng.choice([i, i, None]), " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(120)]
    rows += [rows[3], rows[4], (500, None), (501, ""), (502, "é1 " * 20_000), (503, "--"), (504, "unique")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(0, 9)))) for i in range(25)] + [(None, "a a"), (7, None), (30, "unique"), (31, "Unique!"), (32, "never seen here"), (30, "unique")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as words", "2 as token", "3 as items")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as all", "'x' as word")
    found = decontaminate.contamination(df, bench, window=4, broadcast_bytes=limit)
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found.collect())
    assert got == Counter(contaminated(rows, items, 4))
    assert not re.search("Python|Arrow|Pandas", found._jdf.queryExecution().executedPlan().toString())


def test_no_items_no_documents(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit, r.contaminated) for r in decontaminate.contamination(df, bench).collect()] == [(2, 0, False)]
    assert decontaminate.contamination(df.filter("doc_id > 1"), bench).collect() == []
