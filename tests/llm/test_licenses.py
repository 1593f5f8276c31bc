"""License scan: hand-made texts, a plain version on awkward rows, and the size of what is compared."""
import re

from contactforge.llm import license_scan
from contactforge.llm.license_rules import MARK, REACH, rules

ODD = [
    None, "", " ", "CC BY", "cc-by cc by, CC\nBY!", "Licensed under CC BY-NC 4.0.", "All rights reserved. ALL RIGHTS  RESERVED", "Released under the MIT License.",
    "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: LGPL-2.1-or-later", "the general public license", "generalİ public license",
    "K cc by", "Alle Rechte vorbehalten. Tous droits réservés, TOUS DROITS RÉSERVÉS.", "licensed under the apache license version 2.0 " * 30, "word " * 30000 + "general public license",
    "general public license " * 2000, "x\x00cc\x01by", "same cc by", "same cc by",
]


def plain(text):
    """The scan without windows' neighbours: every detection against every other."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    found, known = [], rules()
    by_keyword = {k: [r for r in known if k in r.keywords] for r in known for k in r.keywords}
    for i, w in enumerate(words):
        near = " " + " ".join([*words[max(0, i - REACH) : i], MARK + " ".join(words[i : i + REACH + 1])]) + " "
        for r in by_keyword.get(w, []):
            m = re.search(r.pattern, near)
            if m:
                start = i - (m[0].split(MARK)[0].count(" ") - 1)
                found.append((start, start + m[0].count(" ") - 1, r))
    beats = lambda o, d: o[0] <= d[0] and o[1] >= d[1] and (o[2].priority, o[1] - o[0], -o[2].order) > (d[2].priority, d[1] - d[0], -d[2].order)
    near = lambda d: (o for o in found if o[0] <= d[0] <= o[1])
    left = [d for d in found if not any(beats(o, d) for o in near(d))] if len(found) < 500 else None
    base = [d for d in found if d[2].base]
    starts = [d[0] for d in base]
    return {
        "n_words": len(words), "n_base": len(base), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted({d[2].label for d in base})),
    } | ({"labels": ",".join(sorted({d[2].label for d in base + left})), "score": max((d[2].weight for d in left), default=0.0),
          "detections": sorted((d[0], d[1], d[2].label) for d in left)} if left is not None else {})


def test_awkward_rows_equal_the_plain_version(docs):
    rows = license_scan.scan(docs(ODD)).collect()
    assert len(rows) == len(ODD) and rows[0].asDict().keys() >= {"lang", "source", "size", "ids"}
    for r in rows:
        own = r.asDict() | {"detections": sorted((d["start"], d["stop"], d["label"]) for d in r["detections"])}
        expected = plain(ODD[r["doc_id"]])
        assert {k: own[k] for k in expected} == expected, ODD[r["doc_id"]][:60]


def test_whole_table_equals_the_plain_version(documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    labelled = 0
    for r in license_scan.scan(documents).collect():
        own = r.asDict() | {"detections": sorted((d["start"], d["stop"], d["label"]) for d in r["detections"])}
        expected = plain(texts[r["doc_id"]])
        labelled += own["labels"] != ""
        assert {k: own[k] for k in expected} == expected
    assert labelled


def test_stronger_detections_suppress_what_they_contain(docs):
    text = "This work is licensed under the GNU General Public License, version 3."
    row = license_scan.scan(docs([text])).first()
    assert row["base_labels"] == "gpl" and row["labels"] == "gpl,gpl-3.0,licence-text"
    assert [d["label"] for d in row["detections"] if d["start"] >= 6] == ["gpl-3.0"]


def test_every_rule_stays_within_reach():
    for r in rules():
        longest = re.sub(r"\{0,(\d+)\}", lambda m: " w" * int(m[1]), r.pattern)
        assert len(longest.split()) <= REACH and r.pattern.count(MARK) == 1 and r.keywords
    assert len(rules()) > 200 and len({(r.order) for r in rules()}) == len(rules())


def test_no_python_and_no_shuffle(docs):
    plan = license_scan.scan(docs(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_empty_table_and_clashing_columns(docs):
    assert license_scan.scan(docs(["a"]).limit(0)).count() == 0
    clash = docs(["cc by"]).selectExpr("*", "'mine' AS labels", "7 AS n_words")
    row = license_scan.scan(clash).first()
    assert row["labels"] == "cc-by" and row["n_words"] == 2
