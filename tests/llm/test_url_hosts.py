"""Hosts as the contract cuts them: ports, user names, dots and case stay part of the host's text."""

from folioflow.llm import op8_url

RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in map(rest.find, "/?#") if i >= 0] + [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    stop = min([i for i in map(path.find, "?#") if i >= 0] + [len(path)])
    return host, path[:stop]


def judge(host, path):
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fits, key=lambda r: (len(r[1]), len(r[2])), default=None)


def test_odd_hosts(spark, tmp_path):
    hosts = ["com", "COM", "a.com", "a.com.", "a.com:80", "user:pw@a.com", "example.com", "example.com:443", "xexample.com", "w.example.com", ".com", "..com", "com.net", "example.net", "e.example.net", "net.", "org", "a..org", "ÉX.org", "[::1]", "", "a b.com"]
    paths = ["", "/", "/en/", "/EN/", "/en/7", "/en/78", "/en", "/de/", "/de/8", "/de/8?x=/en/", "/es/#/en/", "?/en/", "#", "/es/é", "//en/"]
    urls = [f"https://{h}{p}" for h in hosts for p in paths] + [None, "", "com/en/", "://com/en/", "a://b://com/en/", "mailto:x@a.com"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r for r in op8_url.op8_url_filter(spark, str(tmp_path)).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path = cut(url)
        rule = judge(host, path)
        assert (got[i].host, got[i].path) == (host, path), url
        assert got[i].rule == (f"{rule[1]}{rule[2]}" if rule else None), url
        if rule:
            assert got[i].verdict == rule[0], url
