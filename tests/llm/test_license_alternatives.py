import itertools
import re
from re import _parser as parser

from codecorpus.llm import licenses


def examples(parsed):
    """Texts that a name's pattern matches: every alternative, with and without each optional part."""
    ways = []
    for op, value in parsed:
        op = str(op)
        if op == "LITERAL":
            ways.append([chr(value)])
        elif op == "IN":
            kind, what = value[0]
            ways.append([chr(what)] if str(kind) == "LITERAL" else ["1"])
        elif op == "BRANCH":
            ways.append([x for branch in value[1] for x in examples(branch)])
        elif op == "SUBPATTERN":
            ways.append(examples(value[3]))
        else:
            assert op == "MAX_REPEAT", op
            least, most, inner = value
            ways.append([y for k in {least, min(most, least + 1)} for y in ([x * k for x in examples(inner)] if k else [""])])
    return sorted({"".join(x) for x in itertools.product(*ways)})


def test_every_alternative_holds_its_keyword():
    for _, keyword, name in licenses.FAMILIES:
        for text in examples(parser.parse(name)):
            assert re.fullmatch(name, text) and f" {keyword}" in f" {text}", (keyword, text)


def test_rules_are_distinct():
    found = [(r.label, r.pattern) for r in licenses.rules()]
    assert len(found) == len(set(found))


def test_notices_of_every_alternative_are_found(spark):
    rows = [(text, label) for label, _, name in licenses.FAMILIES for text in examples(parser.parse(name))[:1]]
    rows += [("the psf license", "python"), ("zero clause bsd", "0bsd"), ("under the freebsd license", "bsd-2-clause")]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")
    for r in licenses.scan_licenses(docs).collect():
        text, label = rows[r.doc_id]
        family = label.split("-")[0]
        assert r.score > 0 and any(x == label or x.startswith(family) for x in r.labels.split(",")), (text, label, r.labels)
    found = {r.doc_id: r.labels for r in licenses.scan_licenses(docs.filter(docs.doc_id >= len(rows) - 3)).collect()}
    assert [found[k] for k in sorted(found)] == ["python", "0bsd", "bsd-2-clause"]
