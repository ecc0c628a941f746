import hashlib
import re

from reunion.llm.secrets import BASE_RULES, MORE_RULES, build_index, secrets_report, trigram_query

from .util import odd_documents, odd_texts

SF001 = "/root/testdata/sf0.001"


def brute(text, rules):
    out = []
    for k, r in enumerate(rules):
        for m in re.compile(r.pattern, re.ASCII).finditer(text):
            if len(m.group(r.length_group)) >= r.min_chars:
                out.append((m.start(), k, m.end(), r.kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out))


def expected(i, text):
    text = text or ""
    base = brute(text, BASE_RULES)
    n = [sum(x.startswith(r.kind + ":") for x in base.split(",")) for r in BASE_RULES]
    return (i, *n, hashlib.sha256(base.encode()).hexdigest(), brute(text, BASE_RULES + MORE_RULES))


def test_trigram_queries():
    assign = trigram_query(BASE_RULES[0].pattern)
    assert len(assign) == 1 and len(assign[0]) == 6
    assert ("api", "i_k", "key", "pi_", "_ke") not in assign[0] and tuple(sorted(("api", "pi_", "i_k", "_ke", "key"))) in assign[0]
    assert trigram_query(BASE_RULES[1].pattern) == [[("aki", "kia")]]
    assert trigram_query(BASE_RULES[2].pattern) == []
    assert trigram_query("ab(c|de)f") == [[("abc", "bcf"), ("abd", "bde", "def")]]
    assert trigram_query("abcx?def") == [[("abc",)], [("def",)]]


def test_against_plain_regexes(spark):
    got = sorted(map(tuple, secrets_report(odd_documents(spark)).collect()), key=str)
    assert got == sorted((expected(i, t) for i, t in odd_texts()), key=str)
    assert any(r[1] for r in got) and any(r[2] for r in got) and any(r[3] for r in got)


def test_many_matches_and_formats(spark):
    tok = "ghp_" + "a1B2" * 9
    rows = [(1, " ".join(f"token=secret{i:04d}" for i in range(900))), (2, f"-----BEGIN RSA PRIVATE KEY----- {tok} xoxb-1234567890ab https://me:passw0rd@host/"), (3, "passwordsecrettoken no value"), (4, "token=ab token==abcdef TOKEN : 'abcdef'")]
    got = sorted(map(tuple, secrets_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == [expected(i, t) for i, t in rows]
    assert got[0][1] == 900 and "code_host" in got[1][5] and "uri_login" in got[1][5]


def test_whole_table_and_empty(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = secrets_report(docs).collect()
    assert len(got) == len(rows) and all(tuple(r) == expected(r[0], rows[r[0]]) for r in got)
    assert secrets_report(odd_documents(spark, empty=True)).collect() == []


def test_main_path_is_native(spark):
    plan = secrets_report(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_postings(spark):
    p = build_index(spark.createDataFrame([(1, "xABC"), (2, "abd"), (3, None)], "doc_id long, text string"), ["abc", "abd"])
    assert sorted(map(tuple, p.collect())) == [(0, 1), (1, 2)]
