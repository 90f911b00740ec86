from textmart.llm.url_filter import judge


def test_hosts_paths_and_rules(spark):
    urls = [None, "", "no scheme", "http://A.ORG", "http://a.org/x?y=/z", "http://x.example.org/es/1", "HTTP://EXAMPLE.org/en/12/3#a", "http://com/fr/",
            "http://acom/fr/", "http://b.com/de/a", "x://h://p/q", "http://İ.org/ä", "http://h/" + "a/" * 2000]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for c in ("host", "path", "template", "id", "good"):
        rows = rows.withColumn(c, rows.url)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge(rows).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.org", "", None, "allow")
    assert got[4] == ("a.org", "/x", "org/", "allow")
    assert got[5] == ("x.example.org", "/es/1", "example.org/es/", "block")
    assert got[6] == ("example.org", "/en/12/3", "example.org/en/1", "block")
    assert got[7] == ("com", "/fr/", "com/fr/", "allow")
    assert got[8] == ("acom", "/fr/", None, "allow")
    assert got[9] == ("b.com", "/de/a", "com/de/", "block")
    assert got[10] == ("h:", "//p/q", None, "allow")
    assert got[11] == ("İ.org", "/ä", "org/", "allow")
    assert len(got) == len(urls)
    assert judge(rows.limit(0)).count() == 0


def test_templates_and_purity(spark):
    rows = [(k, f"http://h.net/good/{k}", 1) for k in range(200)] + [(1000 + k, f"http://h.net/bad/{k}", 0) for k in range(60)]
    rows += [(2000 + k, f"http://h.net/also/{k}", 1) for k in range(100)] + [(3000, "http://h.net/bad/new", None), (3000, "http://h.net/bad/new", None)]
    got = judge(spark.createDataFrame(rows, "page_id long, url string, good int"), label_col="good").collect()
    by = {r.template: r for r in got}
    assert set(by) == {"good/*", "bad/*", "also/*"}
    assert all(r.verdict == ("block" if r.template == "bad/*" else "allow") for r in got)
    assert sum(r.page_id == 3000 for r in got) == 2
    # the two good branches don't differ from each other, but each from the rest of the host, which holds the bad one
    assert by["good/*"].purity > 0.9 and by["also/*"].purity > 0.9 and by["bad/*"].purity < 0.1


def test_similar_branches_share_their_counts(spark):
    rows = [(k, f"http://h.net/a/{k}", int(k % 10 > 0)) for k in range(100)] + [(500 + k, f"http://h.net/b/{k}", int(k % 9 > 0)) for k in range(90)]
    got = {r.template: r.purity for r in judge(spark.createDataFrame(rows, "page_id long, url string, good int"), label_col="good").collect()}
    assert abs(got["a/*"] - got["b/*"]) < 0.02


def test_one_bad_section_among_many_and_variable_segments(spark):
    rows = [(100 * s + k, f"http://h.net/s{s}/{k}/view", int(s != 17)) for s in range(30) for k in range(12)]
    rows += [(9000 + k, f"http://big.net/u{k % 400}/posts/{k}", 1) for k in range(800)] + [(20_000 + k, f"http://big.net/u7/spam/{k}", 0) for k in range(40)]
    rows += [(30_000 + k, f"http://few.net/only{k}/x", None) for k in range(4)]
    got = {r.page_id: r for r in judge(spark.createDataFrame(rows, "page_id long, url string, good int"), label_col="good").collect()}
    assert all((got[i].verdict == "block") == (1700 <= i < 1712 or 20_000 <= i < 20_040) for i in got)
    assert got[0].template == "s0/*/view" and got[9000].template == "*/posts/*" and got[20_000].template == "u7/spam/*"
    assert got[9007].template == "u7/*/*" and got[30_000].template == "*/*"  # u7 has five pages, its two posts are rarer than that
