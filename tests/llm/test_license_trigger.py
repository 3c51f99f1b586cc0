"""Every licence that the index knows triggers the scan."""

import re

from paceline.llm.license_scan import BASE_PHRASES, TEMPLATES, TRIGGER, license_scan


def test_trigger_matches_what_the_scan_needs():
    trigger = re.compile(TRIGGER)
    for phrases in [(p,) for p in BASE_PHRASES] + [t[2] for t in TEMPLATES]:
        for separator in (" ", "-", ",\n"):
            assert any(trigger.search(p.replace(" ", separator)) and trigger.search(p.upper().replace(" ", separator)) for p in phrases), phrases


def test_short_notices_are_labelled(spark):
    texts = {"Available under the BSD 3-Clause terms.": "bsd", "bsd 2-clause": "bsd", "use it for any purpose, with or without\n fee, is hereby granted": "isc", "a fee without bounds": ""}
    out = license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.labels, r.score > 0) for r in out} == {i: (x, bool(x)) for i, x in enumerate(texts.values())}
    notices = [(i, " ".join((t[1], *t[2]))) for i, t in enumerate(TEMPLATES)]
    found = {r.doc_id: r.labels.split(",") for r in license_scan(spark.createDataFrame(notices, "doc_id long, text string")).collect()}
    assert all(t[0] in found[i] for i, t in enumerate(TEMPLATES))
