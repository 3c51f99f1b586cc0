"""The corpus operators against brute force on small fixtures with nulls, empty and repeated rows and clashing names."""

import base64
import collections
import hashlib
import html
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from paceline.llm import html_extraction, quality_rules
from paceline.llm.components import connected_components
from paceline.llm.decontamination import find_leaks
from paceline.llm.html_extraction import extract_text
from paceline.llm.license_scan import BASE_PHRASES, license_scan
from paceline.llm.lm_scoring import lm_scores
from paceline.llm.ngram_join import Rule, ngram_components
from paceline.llm.pii import replace_pii, without_pii
from paceline.llm.source_mixing import mix_sources, source_rates
from paceline.llm.substring_dedup import substring_dedup
from paceline.llm.warc import assemble, read_records, warc_round_trip, write_warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp int, row int, stats int, key string"


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice(["ba", "ko", "é", "ti", "Na", "lü"]) for _ in range(rng.randint(1, 4))) for _ in range(400)] + ["the", "of", "and"] * 30
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\n", "\t"]) for _ in range(n))
    passage = text(40)
    out = [(i, text(rng.randint(5, 120))) for i in range(60)]
    for i in range(60, 90):
        base = out[rng.randrange(20)][1].split(" ")
        if i % 3:
            base[rng.randrange(len(base))] = "changed"
        out.append((i, " ".join(base)))
    out += [(i, text(10) + " " + passage + " " + text(10)) for i in range(90, 110)]
    out += [(110, None), (111, ""), (112, " \n\t"), (113, "one"), (114, "one"), (115, "one two three"), (116, "ONE two three"), (None, passage), (None, None), (117, text(5000)), (5, out[5][1]), (5, "other words here " * 6), (-3, passage)]
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    data = [(d, t, ["en", "fr", None][(d or 0) % 3], ["a", "a", "b", None][(d or 0) % 4], len(t or ""), 1, 2, 3, "x") for d, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3).cache()


def test_substring_dedup(docs, rows):
    first = {}
    for d, t in rows:
        if d is not None:
            w = words(t)
            for i in range(len(w) - 12):
                k = tuple(w[i : i + 13])
                first[k] = min(first.get(k, d), d)
    expected = []
    for d, t in rows:
        w = words(t)
        gone = set()
        if d is not None:
            for i in range(len(w) - 12):
                if first[tuple(w[i : i + 13])] < d:
                    gone.update(range(i, i + 13))
        expected.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    found = substring_dedup(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found), key=key) == sorted(expected, key=key)
    for r in found:
        assert sum(s.stop - s.start for s in r.removed) == r.n_removed
        assert all(a.stop < b.start for a, b in zip(r.removed, r.removed[1:], strict=False))


def test_mixing_follows_rates_and_repeats(docs, rows):
    out = mix_sources(docs, {"a": 3.0, "b": 1.0}, total=400).collect()
    again = mix_sources(docs.repartition(5), {"a": 3.0, "b": 1.0}, total=400).collect()
    assert collections.Counter((r.doc_id, r.text, r.copy) for r in out) == collections.Counter((r.doc_id, r.text, r.copy) for r in again)
    assert not any(r.source is None for r in out)
    rates = {r.mix_source: r for r in source_rates(docs, {"a": 3.0, "b": 1.0}, 400).collect()}
    assert abs(rates["a"].rate * rates["a"].size - 300) < 1e-6 and rates[None].rate == 0
    counts = collections.Counter(r.source for r in out)
    assert abs(counts["a"] - 300) < 4 * math.sqrt(300) and abs(counts["b"] - 100) < 4 * math.sqrt(100)
    assert set(out[0].asDict()) == set(docs.columns) | {"copy"}


def test_large_rates_are_summed_from_parts(spark):
    d = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"))
    n = mix_sources(d, total=50 * 900).count()
    assert abs(n - 45000) < 5 * math.sqrt(45000)


def test_pii_is_consistent_and_distinct(spark):
    rows = [(1, "Mr. John Smith and Mrs Anna Lee: A.b@C.com, a.B@c.COM, +1 (017) 555-7713 / +1 017 555 7713."), (2, "Herr Müller kennt Frau Иванова; Mr. JOHN SMITH; 4953 9022 5303 5282 10.1.2.3"), (None, 'token = "0b96a8c8d79c4a5085c9196b44e15e09fd311c3c"'), (4, None), (5, ""), (1, "again a.b@c.com"), (1, "again a.b@c.com"), (6, "no entity here 12")]
    d = spark.createDataFrame([(i, t, "k", 7, "e") for i, t in rows], "doc_id long, text string, key string, n_chars long, entities string")
    out = replace_pii(d, "k").collect()
    assert len(out) == len(rows)
    text = " ".join(r.text or "" for r in out)
    for secret in ("John", "JOHN", "Anna", "Müller", "Иванова", "b@C", "555", "4953", "10.1.2.3", "0b96a8c8d79c"):
        assert secret not in text
    mails = re.findall(r"\S+@\S+?\.com", text, re.I)
    assert len(mails) == 4 and len({m.lower() for m in mails}) == 1
    phones = re.findall(r"\+1 \(?\d{3}\)? \d{3}[ -]\d{4}", text)
    assert len(phones) == 2 and len({re.sub(r"\D", "", p) for p in phones}) == 1
    names = re.findall(r"Mr\. (\p{L}+ \p{L}+)".replace(r"\p{L}", "[^\\W\\d_]"), text)
    assert names[0].lower() == names[1].lower() and {n.isupper() for n in names} == {True, False}
    assert re.search("Frau [А-Яа-я]+а", text) and [r for r in out if r.doc_id == 6][0].text == "no entity here 12"
    kept = without_pii(d, "k")
    assert kept.columns == d.columns and {r.n_chars for r in kept.collect() if r.text} == {len(r.text) for r in kept.collect() if r.text}


def test_pii_collisions_are_redrawn(spark):
    values = [f"{i}-{i + 10}-{i + 2000}" for i in range(100, 900)] + [f"10.0.{i // 250}.{i % 250}" for i in range(1500)]
    d = spark.createDataFrame([(i, f"x {v} y") for i, v in enumerate(values)], "doc_id long, text string")
    found = [r.text for r in replace_pii(d, "k").collect()]
    real = {f"x {v} y" for v in values}
    masked = [t for t in found if t not in real]
    assert len(set(masked)) == len(masked) and len(masked) >= 1500


def measures(t):
    t = t or ""
    w, lines = words(t), [x for x in t.split("\n") if WORD.search(x)]
    seen = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again)


def test_quality_base_counts(docs, rows):
    found = quality_rules.quality_rules(docs).collect()
    assert collections.Counter((r.doc_id, *(r[c] for c in quality_rules.COUNTS), r.base_failed) for r in found) == collections.Counter((d, *(m := measures(t)), m[0] < 10 or 100 * m[4] > 20 * m[0]) for d, t in rows)
    assert not any(r.kept and r.base_failed for r in found)


def test_quality_rejects_strange_texts(spark):
    rng = random.Random(3)
    clean = lambda: " ".join(rng.choice(["the", "of", "and", "river", "stone", "was", "near", "walking", "to", "a"]) + rng.choice(["", "", "", ",", "."]) for _ in range(150))
    rows = [(i, clean(), "en") for i in range(60)] + [(100, "".join(rng.choice("#$%*&01 ") + rng.choice("<>|#x ") for _ in range(900)), "en")]
    out = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not out[100].kept and sum(out[i].kept for i in range(60)) >= 58
    kept = quality_rules.quality_filter(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert kept.columns == ["doc_id", "text", "lang"] and 100 not in {r.doc_id for r in kept.collect()}


def test_license_base_and_labels(spark):
    texts = ["Released under the MIT License.", "x apache license y APACHE-LICENSE", "CC BY-NC 4.0; cc by", "GNU General Public License, version 3", None, "", "élan mit-licensex é", "apache", "Licensed under the Apache License, Version 2.0."]
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts)] + [(0, texts[0])]
    out = license_scan(spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, words int, places int")).collect()
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def base(t):
        w = pattern.findall((t or "").translate(LOWER))
        hits = [(i, k) for p, k in BASE_PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        at = [i for i, _ in hits]
        return len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({k for _, k in hits}))

    assert collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out) == collections.Counter((d, *base(t)) for d, t in rows)
    labels = {r.labels for r in out}
    assert "apache,apache-2.0" in labels and "gpl,gpl-3.0" in labels and "cc-by,cc-by-nc" in labels
    assert all(0 <= r.score <= 1 for r in out)


def test_warc_round_trip(spark):
    pages = [(1, "http://a/x y", "<p>é\r\n\r\nWARC/1.1</p>"), (2, None, None), (3, "u", ""), (9, "http://b", "<p>é\r\n\r\nWARC/1.1</p>"), (4, "v", "same"), (None, "w", "same"), (4, "v", "same")]
    d = spark.createDataFrame([(*p, "z", 1) for p in pages], "page_id long, url string, html string, sha string, bytes int")
    out = warc_round_trip(d, payload=True).collect()
    assert len(out) == len(pages) and sum(r.page_id == 4 for r in out) == 2
    least = {}
    for p, _, h in pages:
        if p is not None:
            least[h or ""] = min(least.get(h or "", p), p)
    for r in out:
        h = [x for p, _, x in pages if p == r.page_id][0] or ""
        raw = h.encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        first = least[h] == r.page_id
        assert (r.record_type, r.refers_to) == (("response", None) if first else ("revisit", least[h]))
        assert r.payload == (h if first else None)


def test_warc_assembles_chains(spark, tmp_path):
    d = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    write_warc(d, f"file://{tmp_path}/w")
    records = read_records(spark, f"file://{tmp_path}/w")
    request = records.where("warc_type = 'request'").first().record_id
    chained = records.withColumn("concurrent_to", F.when(F.col("warc_type") == "metadata", F.lit(request)).otherwise(F.col("concurrent_to")))
    out = assemble(chained).collect()
    assert len(out) == 1 and out[0].request.record_id == request and out[0].metadata.page_id == 1 and out[0].response.payload == "x"


def test_warc_of_other_writers_and_large_payloads(spark, tmp_path):
    import gzip

    body = b"<p>" + b"x" * 300_000 + b"</p>"
    http = b"HTTP/1.1 200 OK\r\n\r\n" + body
    digest = base64.b32encode(hashlib.sha1(body).digest())
    record = lambda kind, rid, block, *more: b"\r\n".join([b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: " + rid, *more, b"Content-Length: %d" % len(block), b"", block, b"", b""])
    info, main = record(b"warcinfo", b"<i>", b"software: x\r\n"), record(b"response", b"<r>", http, b"WARC-Payload-Digest: sha1:" + digest)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in (info, main, record(b"request", b"<q>", b"GET / HTTP/1.1\r\n\r\n", b"WARC-Concurrent-To: <r>"))))
    (tmp_path / "a" / "two.warc").write_bytes(record(b"revisit", b"<v>", b"", b"WARC-Refers-To: <r>", b"WARC-Payload-Digest: sha1:" + digest))
    records = {r.record_id: r for r in read_records(spark, f"file://{tmp_path}/a").collect()}
    assert set(records) == {"<i>", "<r>", "<q>", "<v>"} and records["<r>"].payload_bytes == len(body) and records["<r>"].payload == body.decode()
    assert records["<v>"].refers_to == "<r>" and records["<v>"].payload_digest == digest.decode()
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "bad.warc").write_bytes(record(b"response", b"<r>", http, b"WARC-Payload-Digest: sha1:" + digest[::-1]))
    with pytest.raises(Exception, match="doesn't have the digest"):
        read_records(spark, f"file://{tmp_path}/b").collect()


def brute_components(rows, size, percent):
    rows = [(d, t) for d, t in rows if d is not None]
    sets = []
    for _, t in rows:
        w = words((t or "").translate(LOWER))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                up[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), d), d)
    return [(d, len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(rows)]


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_ngram_components(docs, rows, size, percent):
    found = [tuple(r) for r in ngram_components(docs, size, percent).collect()]
    assert len(found) == len(rows) and all(r[2] is None for r in found if r[0] is None)
    assert collections.Counter(r for r in found if r[0] is not None) == collections.Counter(brute_components(rows, size, percent))


@pytest.mark.parametrize("heavy, block", [(1, 1 << 20), (1 << 17, 300)])
def test_ngram_components_of_split_columns_and_cut_blocks(spark, heavy, block):
    rng = random.Random(heavy + block)
    hub = [f"w{i}" for i in range(60)]
    texts = [" ".join(hub)] + [" ".join(rng.choice(["x", "y", w]) if rng.random() < p else w for w in hub) for p in (0.01, 0.02, 0.05, 0.1) for _ in range(12)]
    texts += [" ".join(hub[a : a + n]) for a, n in ((0, 55), (5, 55), (10, 30), (30, 30), (12, 30), (0, 3), (0, 3))] + [" ".join(f"z{rng.randrange(9)}" for _ in range(20)) for _ in range(10)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    rule = Rule(4, 85, heavy, block, paired=8)
    found = ngram_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rule=rule).collect()
    assert collections.Counter(tuple(r) for r in found) == collections.Counter(brute_components(rows, 4, 85))


def test_connected_components_of_a_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (1, 0)], "a long, b long")
    out = dict(tuple(r) for r in connected_components(e).collect())
    assert out == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_html_extraction(spark):
    page = '<html><head><title>no</title></head><body><header>top</header><nav><a href="/">menu</a></nav><div class="ad">buy</div><article><h1>T &amp; t</h1><p><b>one\n two<br>three<p>four</article><div id="comments"><p>me too</p></div><footer>&copy;</footer></body>'
    other = '<body><div class="post-content"><p>' + "long text here " * 9 + "</p><script>if(a<b){x='</p>'}</script><form>f</form></div><aside>s</aside></body>"
    rows = [(1, "http://h/1", page), (2, "http://h/2", None), (3, None, ""), (None, "http://h/3", page), (4, "http://g/1", other), (1, "http://h/1", page)]
    out = extract_text(spark.createDataFrame([(*r, "host", "path") for r in rows], "page_id long, url string, html string, host string, path string")).collect()
    text = "T & t\none two three\nfour"
    assert sorted(((r.page_id or 0), r.text, r.n_chars) for r in out) == sorted([(1, text, len(text))] * 2 + [(0, text, len(text)), (2, "", 0), (3, "", 0), (4, ("long text here " * 9).strip(), len(("long text here " * 9).strip()))])


def test_html_parser_survives_odd_markup():
    for source in ("<", "<a <a <a" * 2000, '<p "' * 500, "<div>" * 3000, "</p>" * 50, "<!-- x", "<script>", "a<b>c</i>d", "<p>&nbsp;&#x41;&bogus;</p>"):
        assert isinstance(html_extraction.Page(source).blocks, list)
    assert html_extraction.Page("<p>&nbsp;&#x41;&bogus;</p>").blocks[0][1] == " ".join(html.unescape("&nbsp;&#x41;&bogus;").split())


def test_lm_scores(docs, rows):
    counts, tokens = collections.Counter(), []
    for d, t in rows:
        w = [*words((t or "").translate(LOWER)), None]
        out = d is not None and zlib.crc32(str(d).encode()) % 7 == 2
        tokens.append((d, out, w))
        if not out:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    expected = sorted((d or 0, out, len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6)) for d, out, w in tokens)
    found = lm_scores(docs).collect()
    assert sorted((r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


def test_lm_probabilities_are_normalised_and_beat_the_unigram(spark):
    import numpy as np

    from paceline.llm.lm_scoring import Model

    rng = np.random.default_rng(1)
    m = Model(rng.normal(size=(2, 1024, 16)).astype(np.float32), rng.normal(size=(1024, 16)).astype(np.float32), rng.normal(size=1024).astype(np.float32))
    logits, z = m.tables()
    for one, two in ((0, 0), (5, 900), (1023, 17)):
        assert abs((10 ** (logits[0][one] + logits[1][two] - z[one, two])).sum() - 1) < 1e-6
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(["red cat sat", "blue dog ran", "old man slept"]) for _ in range(60))) for i in range(300)]
    out = [x for x in lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect() if x.held_out]
    assert len(out) > 20 and sum(x.score for x in out) > sum(x.base_score for x in out) * 0.8


def test_decontamination(spark, rows):
    rng = random.Random(5)
    bank = ["".join(rng.choice(["tor", "mel", "sin", "da", "qu"]) for _ in range(3)) for _ in range(900)]
    items = [(k, " ".join(rng.choice(bank) for _ in range(rng.randint(15, 50)))) for k in range(20)] + [(99, None), (None, "some words"), (98, "")]
    filler = lambda n: " ".join(rng.choice(["the", "of", "river", "stone", "a", "was", *bank[:40]]) for _ in range(n))
    docs, truth = [], set()
    for i in range(60):
        if i % 4 == 0:
            k = i // 4
            w = items[k][1].split()
            if i % 8 == 0:
                w = [x for j, x in enumerate(w) if j % 6]
            docs.append((i, f"{filler(200)} {' '.join(w).upper()} {filler(200)}"))
            truth.add((i, k))
        else:
            docs.append((i, filler(300)))
    docs += [(100, None), (101, ""), (None, items[3][1])]
    d = spark.createDataFrame([(*x, "h") for x in docs], "doc_id long, text string, hits string")
    out = find_leaks(d, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, h.item_id) for r in out for h in r.hits if r.doc_id is not None} == truth
    assert [r.contaminated for r in out if r.doc_id is None] == [True]
    none = find_leaks(d, spark.createDataFrame([], "item_id long, text string")).collect()
    assert len(none) == len(docs) and not any(r.contaminated for r in none)


def test_empty_tables(spark):
    d = spark.createDataFrame([], SCHEMA)
    p = spark.createDataFrame([], "page_id long, url string, html string")
    b = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    for out in (substring_dedup(d), mix_sources(d), replace_pii(d, "k"), quality_rules.quality_rules(d), license_scan(d), ngram_components(d), lm_scores(d), find_leaks(d, b), extract_text(p)):
        assert out.count() == 0
    assert warc_round_trip(p).count() == 0
