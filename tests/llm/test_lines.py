"""Line dedup by site against a plain version on awkward rows."""

import hashlib
from collections import Counter

from haulmark.llm import lines

BLANKS = " \t\r"


def _plain(rows):
    def site(url):
        return url.lower().split("://")[1].split("/")[0] if url and "://" in url else ""

    total = Counter(site(u) for _, u, _ in rows)
    seen = Counter((site(u), x) for _, u, t in rows for x in {y.strip(BLANKS) for y in (t or "").split("\n")})
    for i, u, t in rows:
        h, own = site(u), [] if t is None else t.split("\n")
        kept = [x for x in own if not x.strip(BLANKS) or total[h] < 3 or seen[h, x.strip(BLANKS)] * 100 <= total[h] * 50]
        yield i, h, len(own), len(own) - len(kept), None if t is None else hashlib.sha256("\n".join(kept).encode()).hexdigest()


def test_lines_of_most_pages_of_a_host_go(spark):
    rows = [(i, f"http://A.b/{i}", f"menu\n\n text {i}\r\nmenu \nhalf{i % 2}\nfoot") for i in range(40)]
    rows += [(50, "https://two.x/1?q", "menu\nfoot"), (51, "https://two.x/2", "menu\nfoot"), (52, None, "menu"), (53, "no host", "menu\n" * 3000), (54, "x", None)]
    rows += [(55, "http://a.b", None), (56, "http://a.b?x", ""), rows[3], rows[3], (None, "http://a.b/9", "menu\nalone"), (1, "http://c.d/1", "é\nx"), (2, "http://c.d/2", "é"), (3, "http://c.d/3", "é\né")]
    rows = [(i, u.replace("a.b?x", "a.b/?x") if u else u, t) for i, u, t in rows]
    pages = spark.createDataFrame([(*r, "k", 1) for r in rows], "page_id long, url string, html string, host string, line int")
    assert Counter(tuple(r) for r in lines.report(pages).collect()) == Counter(_plain(rows))
    cleaned = lines.clean(pages)
    assert cleaned.schema == pages.schema and cleaned.count() == len(rows)
    assert lines.report(pages.limit(0)).count() == 0
