"""Rules against plain Python, the model against direct sums, and held-out accuracy."""

import random
import re

from millrace.llm import urls
from millrace.llm.queries import URL_RULES

ODD = [None, "", "no scheme", "http://", "http://org", "http://a.ORG/x", "http://xorg/x", "ftp://a.example.org/es/1?q", "http://example.org/en/12#x", "http://example.org/en/2", "http://a.com/fr/", "http://com/de/?a://b/c", "x://h?p/q", "://a.com/de/1", "http://é.com/fr/ü"]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in URL_RULES:
        name, slash, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + start):
            fits.append((len(rule), rule, verdict))
    return host, path, *((max(fits)[1], max(fits)[2]) if fits else (None, None))


def test_rules(spark):
    rows = [(i, u, "clash") for i, u in enumerate(ODD)] * 2
    frame = spark.createDataFrame(rows, "page_id long, url string, score string")
    found = urls.filtered(frame, URL_RULES).collect()
    assert len(found) == len(rows)
    for row in found:
        host, path, rule, verdict = plain(ODD[row.page_id])
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if verdict else row.verdict in ("allow", "block")
    assert urls.filtered(frame.limit(0), URL_RULES).count() == 0


def test_one_sided_and_no_examples(spark):
    frame = spark.createDataFrame([(1, "http://a.org/"), (2, "http://a.net/")], "page_id long, url string")
    assert {r.verdict for r in urls.filtered(frame, URL_RULES).collect()} == {"allow"}
    assert {r.verdict for r in urls.filtered(frame, []).collect()} == {"allow"}
    assert {r.verdict for r in urls.filtered(frame, [("block", "org/")]).collect()} == {"block"}


def test_probabilities_add_up():
    model = urls.Markov([b"http://abc.example/abc", b"http://abd.example/xyz"])
    import numpy as np

    prefix = b"http://ab"
    total = 0.0
    for c in range(256):
        text, places, _ = urls.spread([prefix + bytes([c])])
        total += float(np.exp(model.logs(text, places)[len(prefix)]))
    assert abs(total - 1) < 1e-3


def test_held_out_accuracy():
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randrange(4, 9)))
    good = [f"https://{word('abcdefgh')}.example/{word('abcdefgh')}".encode() for _ in range(400)]
    bad = [f"http://{word('efghijkl')}.example/?{word('efghijkl')}".encode() for _ in range(400)]
    model = urls.Ratio(good[:300], bad[:300])
    right = (model.scores(good[300:]) >= model.limit).sum() + (model.scores(bad[300:]) < model.limit).sum()
    assert right >= 190


def test_every_ruled_url_is_learned_from(spark):
    """The models equal plain counts over all distinct ruled URLs, more than any fixed number of them."""
    rng = random.Random(6)
    name = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(6, 12)))
    good = [f"https://{name()}.org/{name()}" for _ in range(21_000)]
    bad = [f"https://{name()}.com/de/{name()}" for _ in range(300)]
    rows = [(i, u) for i, u in enumerate(good + bad)] + [(i, good[0]) for i in range(10_000)]
    frame = spark.createDataFrame([*rows, (-1, "https://x.net/")], "page_id long, url string")
    learn = frame.select("url", urls.fitting(urls.host_of(frame.url), urls.path_of(frame.url), URL_RULES).alias("fit"))
    ratio = urls.learned(learn)
    for model, own in zip(ratio.models, (good, bad), strict=True):
        whole = urls.Markov([u.encode() for u in set(own)])
        for table, plain_table in zip(model.tables, whole.tables, strict=True):
            assert all((a == b).all() for a, b in zip(table, plain_table, strict=True))
        times, total = model.tables[0][1], model.tables[0][3]
        assert times.sum() == total.sum() == sum(len(u) + 1 for u in set(own))
    assert -0.5 < ratio.limit < 0.5
    net = [r for r in urls.filtered(frame, URL_RULES).collect() if r.rule is None]
    assert [r.page_id for r in net] == [-1] and abs(net[0].score - ratio.scores([b"https://x.net/"])[0]) < 1e-12
    assert net[0].verdict == ("allow" if net[0].score >= ratio.limit else "block")
