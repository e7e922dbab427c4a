import ast

from codecorpus.operators import extract
from codecorpus.plans import collect
from codecorpus.sources import readers, writers
from tests.conftest import values

FILES = {
    "one/a.py": b"import os\n\n@deco\ndef f(x):\n    def g():\n        return 1\n\n    return g\n\nclass C:\n    class D:\n"
    b"        def m(self):\n            pass\n    async def n(self):\n        return '''a\n  b'''\n",
    "one/crlf.py": b"def f():\r\n    x = 1\r    y = '\xc3\xa9'; return y\r\n",
    "one/bad.py": b"def f(:\n",
    "two/null.py": b"x = '\x00'\n",
    "two/utf.py": b"# \xff\xfe caf\xc3\xa9\ndef h(): return '\xc3\xa9\xff' ; z = 1\ndef i(a,\n      b):\n    return a\n",
    "two/empty.py": b"",
    "two/sp ace+/__init__.py": b"",
    "two/_hidden.py": b"def hidden():\n    pass\n",
    "two/note.txt": b"def no():\n    pass\n",
    "two/copy.py": b"def h(a):\n    # c\n    return a\n\nif 1:\n    def h(a):\n        # c\n        return a\n",
    "zed/copy.py": b"def h(a):\n    # c\n    return a\n",
}


def tree(tmp_path):
    root = tmp_path / "repos"
    for path, content in FILES.items():
        file = root / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(content)
    return str(root)


def expected(path):
    """Straight from the grammar module's own text lookup."""
    text = FILES[path].decode("utf-8", "ignore").replace("\r\n", "\n").replace("\r", "\n")

    def visit(node):
        for child in ast.iter_child_nodes(node):
            if isinstance(child, (ast.FunctionDef, ast.AsyncFunctionDef)):
                yield child
            yield from visit(child)

    nodes = visit(ast.parse(text))
    return [(i, n.name, n.lineno, n.end_lineno, ast.get_source_segment(text, n)) for i, n in enumerate(nodes)]


def test_functions_and_status(spark, tmp_path):
    files = readers.read_source_files(spark, tree(tmp_path))
    parsed = extract.parse_files(files).cache()
    status = dict(values(extract.status_of(parsed), "path", "status"))
    assert set(status) == {p for p in FILES if p.endswith(".py")}
    assert [p for p, s in sorted(status.items()) if s != "parsed"] == ["one/bad.py", "two/null.py"]
    got = values(extract.functions_of(parsed), "path", "seq", "function_name", "start_line", "end_line", "original_code")
    want = sorted((p, *row) for p, s in status.items() if s == "parsed" for row in expected(p))
    assert got == want
    assert extract.segment_errors(parsed).count() == 0
    asyncs = parsed.filter("is_async").collect()
    assert [r.function_name for r in asyncs] == ["n"]


def test_whole_flow(spark, tmp_path):
    root = tree(tmp_path)
    (tmp_path / "urls.txt").write_text("# two is below\nhttps://h/x/one.git\n\nhttps://h/y/two\n")
    table, counters = collect.collect_functions(spark, root, str(tmp_path / "urls.txt"))
    assert table.columns == readers.FUNCTION_SCHEMA.fieldNames()
    c = counters.first().asDict()
    rows = values(table, "repo_name", "repo_url", "file_path", "function_name")
    assert (c["files_scanned"], c["files_parsed"], c["files_syntax_error"], c["files_other_error"]) == (10, 8, 2, 0)
    raw = sum(len(expected(p)) for p in FILES if p.endswith(".py") and p not in ("one/bad.py", "two/null.py"))
    assert c["functions_raw"] == raw
    assert c["functions_raw"] == sum(
        c[k] for k in ("short_functions", "long_functions", "empty_functions", "invalid_lines", "duplicates", "functions_written")
    )
    assert len(rows) == c["functions_written"] and c["duplicates"] == 1
    assert ("one", "https://h/x/one.git", "a.py", "f") in rows
    # The comment line is the first that holds "two"; zed is in no line.
    assert ("two", "# two is below", "utf.py", "i") in rows
    assert not any(r[0] == "zed" for r in rows)
    report = collect.description(counters)
    writers.write_report(report, str(tmp_path / "report"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert lines[0] == "Total Python files scanned: 10" and len(lines) == 11

    capped, counters = collect.collect_functions(spark, root, str(tmp_path / "urls.txt"), max_functions=2)
    assert capped.count() == 2 == counters.first().functions_written
    assert counters.first().files_scanned < 10


def test_a_failing_segment_is_a_row_of_its_own(monkeypatch):
    source = b"def good():\n    return 1\n\ndef bad():\n    return 2\n\ndef after():\n    return 3\n"
    cut = extract._segment

    def failing(lines, node):
        if node.name == "bad":
            raise UnicodeDecodeError("utf-8", b"\xff", 0, 1, "cut inside a character")
        return cut(lines, node)

    monkeypatch.setattr(extract, "_segment", failing)
    rows = extract._file_rows("x/y.py", source)
    assert [(r[2], r[3]) for r in rows] == [("parsed", None), ("function", "good"), ("segment_error", "bad"), ("function", "after")]
    assert rows[2][7] is None and rows[3][7] == "def after():\n    return 3"


def test_a_mounted_tree_is_listed_and_read_by_tasks(spark, tmp_path, monkeypatch):
    """The driver asks for the first level alone; empty, hidden and ``_`` files are read like the others."""
    from codecorpus.sources import readers

    want = {"a.py": b"x = 1\n", "repo/__init__.py": b"", "repo/deep/er/m.py": b"y = 2\n", "repo/.hidden.py": b"z"}
    for name, content in {**want, "repo/notes.txt": b"no"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)

    def no_listing(*_):
        raise AssertionError("the driver listed the whole tree")

    monkeypatch.setattr(readers, "list_files", no_listing)
    monkeypatch.setattr(readers, "FRAME_BYTES", 1)
    for root in (str(tmp_path), f"file://{tmp_path}/", f"file:{tmp_path}"):
        got = readers.read_source_files(spark, root).collect()
        assert {r.path: bytes(r.content) for r in got} == want and len(got) == len(want)


def test_definitions_visit_no_expression(monkeypatch):
    import ast

    from codecorpus.operators import extract

    def no_walk(_):
        raise AssertionError("an expression was visited")

    monkeypatch.setattr(ast, "iter_child_nodes", no_walk)
    text = "\n".join([
        "try:", "    def a(): pass", "except E:", "    def b(): pass", "else:", "    def c(): pass", "finally:", "    def d(): pass",
        "match x:", "    case 1:", "        async def e():", "            if (lambda y: y)(1 if 2 else 3):", "                def f(): pass",
        "            else:", "                class G:", "                    def h(self): pass", "def i(): pass",
    ])
    assert [n.name for n in extract._definitions(ast.parse(text))] == list("abcdefhi")
