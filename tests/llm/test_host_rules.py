import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from plateworks.llm import host_rules


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines, seen, dup = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), len(lines)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab #|\n\t\x0b\x1c é", max_size=60))
def test_features_match_brute_force(text):
    assert host_rules.text_features(text) == brute(text)


def prose(k):
    return " ".join(f"word{k}x{i}" for i in range(80))


def test_verdicts(spark):
    rows = [(k, prose(k), "good") for k in range(40)] + [(100 + k, "spam spam spam " * 30, "bad") for k in range(40)]
    rows += [(200, prose(200), "bad"), (201, prose(201) + " # # # # # # # # # # # # # #", "bad"), (300, "short", "tiny"), (301, prose(301), None), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'x' as host", "1 as n_words")
    got = {r.doc_id: r for r in host_rules.judge(docs, docs["source"]).collect()}
    assert len(got) == len(rows)
    assert all(got[k].kept for k in range(40)) and not any(got[k].kept for k in range(100, 140))
    assert got[100].host_failed and got[200].kept and not got[201].kept and not got[201].base_failed
    assert not got[300].kept and not got[300].host_failed and got[301].kept and not got[None].kept and got[None].n_words == 0
    assert host_rules.judge(docs.limit(0), docs["source"]).count() == 0


def test_failing_hosts_match_the_sql(spark, tmp_path):
    """Hosts that fail each rule, hosts near the limit, and repeated rows, against the query's SQL."""
    rows = []
    for host in range(30):
        bad = [0.0, 0.3, 0.5, 0.7, 0.9, 1.0][host % 6]
        fault = ["base", "symbols", "lines", "word_length"][host % 4]
        for k in range([4, 25, 60][host % 3]):
            text = prose(1000 * host + k)
            if k < bad * [4, 25, 60][host % 3]:
                text = {"base": "spam spam spam " * 30, "symbols": text + " #" * 40, "lines": "\n".join([text] + ["same line"] * 9), "word_length": text.replace("word", "averyverylongword")}[fault]
            rows.append((1000 * host + k, text, f"host{host}"))
    rows += [rows[0], rows[0], (7, None, None), (8, "", "host1")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = host_rules.op8_host_rules(spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(host_rules.OP8_SQL).df()[list(got.columns)]
    text = lambda d: sorted(map(str, d.itertuples(index=False, name=None)))
    assert text(got) == text(want) and got.host_failed.sum() > 100
    assert (got.base_failed == 0).sum() > got.kept.sum()  # the hosts' verdicts take documents that pass the base rule


def test_a_very_long_text():
    assert host_rules.text_features("long text # " * 100_000) == (300_000, 900_000, 100_000, 0, 300_000, 1)
