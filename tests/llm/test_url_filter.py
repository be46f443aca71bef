import fnmatch
import random
import re

from tripstream.llm import url_filter as u
from tripstream.llm.common import ready


def as_regex(glob):
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**", i):
            out, i = out + ".*", i + 2
        elif glob[i] == "*":
            out, i = out + "[^/]*", i + 1
        else:
            i += glob[i] == "\\"
            out, i = out + re.escape(glob[i]), i + 1
    return re.compile(out + r"\Z", re.S)


def test_automaton_against_regex():
    rng = random.Random(5)
    globs = ["", "*", "**", "a*b", "*/a**", "\\*a", "é*"] + [
        "".join(rng.choice(["a", "b", "/", ".", "*", "**"]) for _ in range(rng.randint(1, 30))) for _ in range(60)]
    urls = ["", "a", "/", "ab", "*a", "é/é"] + [
        "".join(rng.choice("ab/.") for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["a" * 5000, "ab/" * 3000]
    auto = u.GlobAutomaton(globs)
    assert auto.words > 2
    got = auto.run([x.encode() for x in urls])
    patterns = [as_regex(g) for g in globs]
    for k, x in enumerate(urls[:-2]):
        assert got[k].tolist() == [bool(p.match(x)) for p in patterns], x
    assert got[-2, 2] and not got[-1, 1] and got[-1, 2]
    assert fnmatch.fnmatch("x.exe", "*.exe")


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group().translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    best = None
    for act, h, p in u.SITE_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and len(h + p) > len(best[1] if best else ""):
            best = (act, h + p)
    query = re.match(r"[^?#]*(\?[^#]*)?", rest).group(1) or ""
    blocked = sum(bool(as_regex(g).match(host + path + query)) for g in u.BLOCK_GLOBS)
    return (host, path, best[1] if best else None, best[0] if best else "block" if blocked else "allow", blocked)


def test_verdicts(spark):
    ready(spark)
    urls = [None, "", "no scheme", "http://", "HTTP://A.ORG", "http://a.org/", "http://org/", "http://xorg/x", "http://a.example.org/es/1",
            "http://example.org/en/17?page=2", "http://example.org/en/2", "http://xexample.org/es/", "https://b.COM/de/x#y",
            "https://b.com/fr/login", "https://b.com/en/login", "https://b.net/?page=1", "https://b.net/#?page=1",
            "http://x.net/a.org/en/1", "http://x/://y.org/z", "ftp://my.casino.net/", "http://İ.com/fr/", "http://a.net/x\ny",
            "http://a.net/" + "z" * 20_000 + ".exe", "http://b.net:80/a.zip?x"]
    urls += urls[:3]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.n_globs) for r in u.judge_urls(df).collect()}
    assert got == {i: brute(x) for i, x in enumerate(urls)}
    assert u.judge_urls(df.limit(0)).count() == 0
    assert u.judge_urls(df, rules=[], block_globs=[]).where("verdict != 'allow'").count() == 0


def test_query_without_a_path(spark):
    ready(spark)
    urls = ["http://shop.example?ref=news.org/x", "http://shop.example?a.org/", "http://a.org?x.com/en/1", "http://a.org/?x.com/en/1"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.n_globs) for r in u.judge_urls(df).collect()}
    assert got == {i: brute(x) for i, x in enumerate(urls)}
    assert got[0][2] is None
