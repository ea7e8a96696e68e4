import random

import pytest
from pyspark.sql import functions as F

from tesserae.llm import warc

SCHEMA = "record_id long, url string, ts long, revisit boolean, headers map<string,string>, key string"


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    return {r["record_id"]: r for r in warc.resolve(df, **options).collect()}


@pytest.mark.parametrize("per_bucket", [3, 20, 100_000])
def test_latest_earlier_response(spark, per_bucket):
    rows = [(i, "http://www.A.com/p/?utm_source=x#top", 10 * i, False, {"etag": f'"{i}"', "content-type": "t", "date": str(i)}) for i in range(1, 40)]
    rows += [(1000 + t, "https://a.com:443/p", t, True, {"etag": f'W/"{(t - 1) // 10}"', "date": "new", "content-type": "no"}) for t in range(0, 400, 7)]
    got = run(spark, rows, per_bucket=per_bucket)
    for t in range(0, 400, 7):
        r, want = got[1000 + t], min(39, (t - 1) // 10)
        if want < 1:
            assert (r["status"], r["response_id"]) == ("no_earlier_response", None)
        else:
            assert (r["status"], r["response_id"]) == ("resolved", want)
            assert r["headers"] == {"etag": f'W/"{want}"', "date": "new", "content-type": "t"}


def test_validators(spark):
    full = {"etag": '"a"', "last-modified": "m", "server": "s"}
    rows = [(1, "a.com/x", 1, False, full), (2, "a.com/x", 1, False, full)]
    asks = [{"etag": '"b"'}, {"last-modified": "n"}, {"etag": '"a"', "last-modified": "n"}, {}, None]
    rows += [(10 + i, "a.com/x", 5, True, h) for i, h in enumerate(asks)] + [(20, None, 5, True, {}), (21, "a.com/x", None, True, {}), (22, "b.com", 9, True, {}), (23, "a.com/x", 1, True, {})]
    rows += [(30, "a.com/x", 5, True, {}), (30, "a.com/x", 5, True, {})]
    got = run(spark, rows)
    assert [got[10 + i]["status"] for i in range(5)] == ["validator_mismatch", "validator_mismatch", "resolved", "resolved", "resolved"]
    assert got[10]["response_id"] == 2 and got[10]["headers"] is None
    assert got[14]["headers"] == full
    assert {got[i]["status"] for i in (20, 21, 22, 23)} == {"no_earlier_response"}


def test_empty(spark):
    assert run(spark, []) == {}


def test_canonical_urls(spark):
    urls = ["http://www.Ex.com/", "https://ex.com", "ex.com:80/#a", "http://ex.com/?utm_a=1&ref=x", "ex.com/a?b=1&utm_x=2&c=3", "ex.com/a/?b=1", "ex.com/a?c=3&b=1", None, ""]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(warc.canonical_url(F.col("u"))).collect()]
    assert got == ["ex.com"] * 4 + ["ex.com/a?b=1&c=3", "ex.com/a?b=1", "ex.com/a?b=1&c=3", None, ""]


@pytest.mark.parametrize("per_bucket", [2, 7, 100_000])
def test_against_brute_force(spark, per_bucket):
    """Interleaved captures of few URLs, bursts at one time, and null headers."""
    rng = random.Random(per_bucket)
    rows = []
    for i in range(600):
        url = rng.choice(["http://a.com/x", "https://www.a.com/x/", "b.com", "c.com/?q=1"])
        ts = 50 if rng.random() < 0.4 else rng.randint(0, 100)
        rows.append((i, url, ts, rng.random() < 0.5, rng.choice([None, {"etag": str(ts // 9), "server": None}, {"last-modified": str(ts // 20)}, {"date": str(i)}])))
    key = {"http://a.com/x": "a.com/x", "https://www.a.com/x/": "a.com/x", "b.com": "b.com", "c.com/?q=1": "c.com?q=1"}
    got = run(spark, rows, per_bucket=per_bucket)
    assert len(got) == sum(r[3] for r in rows)
    for i, url, ts, revisit, own in rows:
        if revisit:
            full = max(((t, j, h) for j, u, t, r, h in rows if not r and key[u] == key[url] and t < ts), key=lambda x: x[:2], default=None)
            own, theirs = ({k: v for k, v in (h or {}).items() if v is not None} for h in (own, full[2] if full else None))
            agrees = all(own[k] == theirs[k] for k in ("etag", "last-modified") if k in own and k in theirs)
            status = "no_earlier_response" if not full else "resolved" if agrees else "validator_mismatch"
            assert (got[i]["canonical_url"], got[i]["status"], got[i]["response_id"]) == (key[url], status, full and full[1])
            assert got[i]["headers"] == (theirs | own if status == "resolved" else None)


def test_columns_of_other_names(spark):
    df = spark.createDataFrame([(1, "a.com", 1, False, {"etag": "x"}, 5, 6, "s"), (2, "a.com", 2, True, {"etag": "x"}, 5, 6, "s")], "record_id long, url string, ts long, revisit boolean, headers map<string,string>, bucket int, cuts int, status string")
    assert [tuple(r)[:4] for r in warc.resolve(df).collect()] == [(2, "a.com", "resolved", 1)]


def test_responses_without_ids(spark):
    """They resolve revisits, too, where no response of the same time has an id."""
    df = spark.createDataFrame([(None, "a.com", 1, False, {"etag": "x"}), (5, "a.com", 2, True, {"etag": "x"}), (None, "b.com", 1, False, {"etag": "x"}), (1, "b.com", 1, False, {"etag": "y"}), (6, "b.com", 2, True, {"etag": "y"})], "record_id long, url string, ts long, revisit boolean, headers map<string,string>")
    assert sorted(tuple(r)[:4] for r in warc.resolve(df).collect()) == [(5, "a.com", "resolved", None), (6, "b.com", "resolved", 1)]
