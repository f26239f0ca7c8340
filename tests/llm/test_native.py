"""Quality rules, mixing and URL rules: odd rows and plain versions."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from grainmill.llm import common, mixing, quality, urlfilter
from grainmill.operators import sizing

DOCS = "doc_id long, text string, lang string, source string, salt string, size string, kept string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", "y", "z") for i, t, lang, s in rows], DOCS)


def counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    again = {w for w in windows if windows.count(w) > 1}
    covered = {k for i, w in enumerate(windows) if w in again for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_counts_and_verdicts(spark):
    rnd = random.Random(4)
    clean = lambda n: " ".join(rnd.choice(["alpha", "béta", "gamma", "delta", "eps"]) + str(rnd.randrange(10**6)) for _ in range(n))
    rows = [(i, clean(60), "en", "a") for i in range(80)]
    rows += [
        (100, " ".join(w + "###" for w in clean(60).split()), "en", "a"),
        (101, "\n".join([clean(6)] + ["Same line again"] * 12 + [clean(30)]), "en", "a"),
        (102, clean(60).upper() + " SHOUTED", "en", "a"),
        (103, "a b c d e f g h i j " * 5, "en", "a"),
        (104, None, "en", "a"), (105, "", None, None), (106, "too short", "en", "a"), (107, clean(40), None, None),
        (108, clean(40) + "\x0b\x0c\r\n \t\n" + clean(3), "en", "rare"), (None, clean(40), "en", "a"),
        (109, "q " * 7 + clean(40_000), "en", "a"), (0, rows[0][1], "en", "a"),
    ]
    got = quality.quality_rules(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted((i is None, i or 0, *counts(t)) for i, t, *_ in rows if i != 109)
    have = sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got if r.doc_id != 109
    )
    assert have == want
    assert {r.doc_id for r in got if r.doc_id == 109 and r.n_repeat_words == 7}
    assert {r.doc_id for r in got if not r.kept} == {100, 101, 102, 103, 104, 105, 106}
    kept = quality.good_documents(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns and kept.count() == len(rows) - 7
    assert quality.quality_rules(frame(spark, [])).count() == 0 and quality.good_documents(frame(spark, [])).count() == 0


def test_sketch_is_mergeable_and_close(spark):
    rows = spark.range(20_000).selectExpr("id % 2 as half", "'g' as g", "cast(pow(id, 1.5) as long) as v")
    both = quality.sketches(rows, ["g"], ["v"])
    merged = quality.sketches(rows.where("half = 0"), ["g"], ["v"]).union(quality.sketches(rows.where("half = 1"), ["g"], ["v"]))
    merged = merged.groupBy("g", "measure", "bin").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, merged.collect()))
    q = quality.quantiles(merged, ["g"], {"mid": 0.5, "high": 0.75}).first()
    exact = rows.selectExpr("percentile(v, 0.5) as mid", "percentile(v, 0.75) as high").first()
    assert abs(q.mid / exact.mid - 1) < 1 / 16 and abs(q.high / exact.high - 1) < 1 / 16


def webster(claims, seats):
    """Highest quotients, one by one; ties go to the first party."""
    won = [0] * len(claims)
    for _ in range(seats):
        best = max(range(len(claims)), key=lambda i: (claims[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


def test_apportionment_is_highest_quotients(spark):
    rnd = random.Random(9)
    for group in range(6):
        claims = [float(rnd.choice([0, 1, 3, 10, 1000, 5000]) * rnd.randrange(1, 50)) for _ in range(rnd.randrange(1, 25))]
        seats = rnd.choice([0, 1, 7, 100, 3000])
        if not any(claims):
            continue
        rows = spark.createDataFrame([("g", i, c) for i, c in enumerate(claims)], "g string, i int, c double")
        got = mixing.apportion(rows, F.lit(float(seats)), F.col("c"), F.lit(2**62), ["g"], [F.col("i").asc()])
        assert [r.quota for r in got.orderBy("i").collect()] == webster(claims, seats), (claims, seats)


def test_mix(spark):
    rnd = random.Random(1)
    rows, i = [], 0
    for source, n in (("a", 50), ("b", 20), ("é", 4), (None, 10), ("void", 3)):
        for _ in range(n):
            text = None if source == "void" else " ".join(f"{source}{rnd.randrange(99)}" for _ in range(rnd.randrange(0, 300)))
            rows.append((i, text, "en", source))
            i += 1
    rows += [(0, rows[0][1], "en", "a"), (None, "one two three", "en", "b")]
    docs = frame(spark, rows)
    got = mixing.mixed(docs, shard_words=1500).collect()
    assert len(got) == len(rows)
    sizes, taken, targets = {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        targets[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    weights = dict(zip(sorted((s for s in sizes if s is not None)) + [None], [5, 2, 1, 5, 2], strict=True))
    level = dict.fromkeys(sizes, 0.0)
    stopped = set()
    while True:  # fill up by weight until nobody is above three times its size
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in stopped)
        open_weight = sum(w for s, w in weights.items() if s not in stopped)
        level = {s: 3 * sizes[s] if s in stopped else rest * weights[s] / open_weight for s in sizes}
        above = {s for s in sizes if level[s] > 3 * sizes[s]} - stopped
        if not above:
            break
        stopped |= above
    for s in sizes:
        assert abs(targets[s] - level[s]) < 1e-6 * max(1, level[s])
        assert abs(taken[s] - targets[s]) <= 60, (s, taken[s], targets[s])
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixed(docs, shard_words=1500).collect()))
    texts = mixing.mixed_documents(docs)
    assert texts.columns == ["doc_id", "text", "lang", "source", "salt", "kept", "size", "source_size", "target", "taken"]
    own = {}
    for i, t, *_ in rows:
        own.setdefault(i, set()).update(WORD.findall(t or ""))
    for r in texts.collect():
        assert len(r.text.split(" ")) == r.taken > 0 and set(r.text.split(" ")) <= own[r.doc_id]
    assert mixing.mixed(frame(spark, [])).count() == 0 and mixing.mixed_documents(frame(spark, [])).count() == 0
    assert mixing.mixed(frame(spark, [(1, None, None, None)])).first().taken == 0


def test_mix_of_empty_texts_and_repeated_ids(spark):
    rows = [(i, "" if i % 2 else None, "en", "void") for i in range(3000)]
    rows += [(7, f"{c} " * 40, "en", "a") for c in "pqrst"] + [(7, "p " * 40, "en", "a"), (None, None, "en", None)] + [(9, "w " * 200, "en", "b")]
    docs = frame(spark, rows)
    got = mixing.mixed(docs)
    assert got.count() == len(rows) and got.where("size = 0 and (taken > 0 or start > 0 or blocks > 0)").count() == 0
    assert got.where("size = 0").select("target", "source_size").distinct().count() == 1
    plan = got.where("size > 0").select("content", "taken").collect()
    texts = [r.text.split(" ") for r in mixing.mixed_documents(docs).collect()]
    want = sorted((r.taken for r in plan if r.taken))
    assert sorted(map(len, texts)) == want and all(len(set(t)) == 1 for t in texts)
    by_word = {hashlib.md5((f"{c} " * n).encode()).digest(): c for c, n in [*zip("pqrst", [40] * 5), ("w", 200)]}
    assert sorted((by_word[bytes(r.content)], r.taken) for r in plan if r.taken) == sorted((t[0], len(t)) for t in texts)


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def best_rule(host, path, rules):
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)


def test_url_rules(spark):
    rules = [*urlfilter.RULES, ("a.b.example.net", "/x", "block"), ("example.net", "/x/y/z", "allow"), ("net", "", "allow"), ("quer.net", "/q", "block")]
    urls = [
        None, "", "no scheme", "http://", "http://net", "http://Net/", "https://EXAMPLE.net/en/", "https://a.example.net/en/x?y=/de/", "x://myexample.net/en/",
        "http://example.com/de/", "http://example.com/de", "http://example.com#/de/", "http://É.org/fr/é", "http://org/fr/?", "http://a.b.example.net/x/y/z/w",
        "http://c.a.b.example.net/xx", "http://example.net//x", "http://quer.net/qu/", "http://user@example.net:80/", "a://b://net/", "http://..net/",
        "http://" + "s." * 3000 + "net/" + "p/" * 3000,
    ]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)] + [(5, "http://Net/", "h", "r")], "page_id long, url string, host string, rule string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = urlfilter.url_verdicts(pages, table).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        host, path = split_url(urls[r.page_id])
        rule = best_rule(host, path, rules)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule and rule[0] + rule[1], rule[2] if rule else "allow"), urls[r.page_id]
    assert urlfilter.url_verdicts(pages.limit(0), table).count() == 0
    assert {r.verdict for r in urlfilter.url_verdicts(pages, table.limit(0)).collect()} == {"allow"}


def test_digest_is_of_the_whole_key(spark):
    keyed = urlfilter.keyed_rules(spark.createDataFrame([("net", "/a/b", "block")], "host string, path string, verdict string")).first()
    assert keyed.r_digest == hashlib.sha256(b"net\n/a/").hexdigest() and keyed.r_short == keyed.r_digest[:8]


def test_join_is_on_the_short_prefix(spark, monkeypatch):
    """Also where the rules are too many to broadcast, and where prefixes collide."""
    sites = spark.createDataFrame([("a.net", "/en/x", 1), ("b.org", "/", 2)], "host string, path string, d_n long").withColumn("d_key", F.unhex(F.sha2("host", 256)))
    rules = spark.createDataFrame([(f"{c}.net", "/en/", "block") for c in "abcdefgh"], "host string, path string, verdict string")
    for limit, digits in ((2**26, 8), (0, 8), (0, 1)):
        monkeypatch.setattr(sizing, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(urlfilter, "PREFIX_HEX", digits)
        best = urlfilter.best_rules(sites, rules)
        assert re.search(r"Join \[short#\d+\], \[r_short#\d+\]", best._jdf.queryExecution().executedPlan().toString())
        assert sorted((r.d_n, r.rule) for r in best.collect()) == [(1, "a.net/en/"), (2, None)]


def test_hot_url(spark):
    """A third of all rows on one URL, another third without any: dealt over keys of their own, verdicts as for all."""
    rows = [(i, "http://a.net/x" if i % 3 == 0 else None if i % 3 == 1 else f"http://h{i}.example.com/de/") for i in range(6000)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    table = spark.createDataFrame(urlfilter.RULES, "host string, path string, verdict string")
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.url_verdicts(pages, table).collect()}
    assert len(got) == 6000
    for i, (rule, verdict) in got.items():
        assert (rule, verdict) == (("net/", "block"), (None, "allow"), ("example.com/de/", "block"))[i % 3]


def test_join_by_count_deals_hot_keys(spark):
    digest = F.unhex(F.sha2(F.col("k").cast("string"), 256))
    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id")).alias("k"))
    dim = rows.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("d_n")).select(digest.alias("d_key"), "d_n", F.col("k").alias("found"))
    placed, _ = common._placed(rows, digest, dim, 6000)
    assert placed.groupBy("_row_key").count().agg(F.max("count")).first()[0] == 1
    got = common.join_by_count(rows, digest, dim, 6000)
    assert got.columns == ["id", "k", "found"] and got.count() == 9000 and got.where("not (k <=> found)").count() == 0
