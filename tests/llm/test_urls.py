"""What the url tree says about urls that no rule decides."""

from strata.llm import urls


def judged(spark, cases):
    rows = urls.judge(spark.createDataFrame(list(enumerate(cases)), "page_id LONG, url STRING")).collect()
    assert len(rows) == len(cases)
    return {r.page_id: r for r in rows}


def test_undecided_urls_follow_the_evidence_near_them(spark):
    blocked = [f"http://bad.net/{lang}/{i}/p{i}" for lang in ("es", "fr") for i in range(20)]
    alike = [f"http://bad.net/en/{i}/p{i}" for i in range(20)]
    other = ["http://bad.net/about"]
    allowed = [f"http://good.example.com/fr/{i}" for i in range(40)]
    few = ["http://few.net/es/1", "http://few.net/en/1"]
    none = [f"http://x.org/en/{i}" for i in range(5)]
    cases = blocked + alike + other + allowed + few + none
    found = judged(spark, cases)
    verdict = {u: (found[i].rule is None, found[i].verdict, found[i].purity) for i, u in enumerate(cases)}
    assert {verdict[u][:2] for u in alike} == {(True, "block")}
    assert verdict[other[0]][:2] == (True, "block")  # forty blocked urls on its host
    assert {verdict[u][:2] for u in (few[1], *none)} == {(True, "allow")}
    assert verdict[few[1]][2] > verdict[none[0]][2]  # one blocked sibling is a little evidence
    assert {verdict[u][1] for u in allowed} == {"allow"}


def test_mixed_evidence_does_not_reject(spark):
    rules = (urls.Rule("block", "h.net", "/es/"), urls.Rule("allow", "h.net", "/fr/"), urls.Rule("block", "net", "/xx/"))
    cases = [f"http://h.net/{lang}/{i}" for lang in ("es", "fr", "en") for i in range(20)]
    cases += [f"http://g{k}.net/xx/{i}" for k in range(9) for i in range(20)] + ["http://new.net/en/1"]
    rows = urls.judge(spark.createDataFrame(list(enumerate(cases)), "page_id LONG, url STRING"), rules).collect()
    found = {r.page_id: r for r in rows}
    assert {found[i].verdict for i in range(40, 60)} == {"allow"}
    unknown = found[len(cases) - 1]  # a host without labels, where nine tenths of all labelled urls are blocked
    assert (unknown.verdict, unknown.purity) == ("allow", 0.5)
