import json

import pytest

yaml = pytest.importorskip("yaml")

from routelore import cli  # noqa: E402

ROUTES = """routes:
  - name: a
    description: first
    parameters: {type: object, properties: {id: {type: string}}, required: [id], additionalProperties: false}
  - name: b
"""


def test_validate_and_split(spark, tmp_path, capsys):
    (tmp_path / "routes.yaml").write_text(ROUTES)
    rows = [{"id": f"{r}{i}", "input": f"text {r} {i}", "route": {"name": r} | ({"arguments": {"id": "x"}} if r == "a" else {})} for r in "ab" for i in range(5)]
    data = tmp_path / "rows.jsonl"
    data.write_text("".join(json.dumps(r) + "\n" for r in rows))
    assert cli.main(["validate", str(data), "--routes", str(tmp_path / "routes.yaml")]) == 0
    assert json.loads(capsys.readouterr().out)["total"] == 10
    out = tmp_path / "out"
    assert cli.main(["split", str(data), "--routes", str(tmp_path / "routes.yaml"), "--seed", "42", "--out", str(out)]) == 0
    assert json.loads((out / "manifest.json").read_text())["rows"] == {"train": 6, "validation": 2, "test": 2}
    lines = [json.loads(x) for p in sorted((out / "train.jsonl").glob("part-*")) for x in p.read_text().splitlines()]
    assert [r["route"]["name"] for r in lines] == ["a"] * 3 + ["b"] * 3
    assert cli.main(["split", str(data), "--routes", str(tmp_path / "routes.yaml"), "--seed", "42", "--out", str(out)]) == 1
    data.write_text(data.read_text() + "{}\n")
    assert cli.main(["validate", str(data), "--routes", str(tmp_path / "routes.yaml")]) == 1
    assert "rows.jsonl:11" in capsys.readouterr().err


def test_compare(spark, tmp_path, capsys):
    from routelore.functions.codec import CALL, END_CALL

    (tmp_path / "old.yaml").write_text(ROUTES)
    (tmp_path / "new.yaml").write_text(ROUTES + "  - name: c\n")
    rows = [{"id": str(i), "input": f"text {i}", "route": {"name": "b"}} for i in range(10)]
    (tmp_path / "replay.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    call = lambda name: f"{CALL}call:{name}{{}}{END_CALL}"
    for name, said in (("parent", ["b"] * 9 + ["c"]), ("child", ["b"] * 8 + ["c"] * 2)):
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps({"raw_completion": call(x)}) + "\n" for x in said))
    at = lambda name: str(tmp_path / name)
    base = ["compare", at("replay.jsonl"), "--parent-routes", at("old.yaml"), "--child-routes", at("new.yaml"), "--parent-completions", at("parent.jsonl"), "--child-completions", at("child.jsonl")]
    assert cli.main(base) == 1
    found = json.loads(capsys.readouterr().out)
    assert found["old_route_names"] == ["a", "b"] and found["regression_data"]["rows"] == 10 and found["parent"]["data"] == found["child"]["data"] == found["regression_data"]
    assert (found["parent"]["metrics"]["route_accuracy"], found["child"]["metrics"]["route_accuracy"]) == (0.9, 0.8) and abs(found["route_accuracy_drop"] - 0.1) < 1e-9 and not found["passed"]
    assert found["parent"]["invalid"] != found["child"]["invalid"]  # c is unknown to the parent, a wrong route for the child
    assert cli.main([*base, "--max-route-accuracy-drop", "0.11", "--max-argument-accuracy-drop", "0.11"]) == 0
    assert json.loads(capsys.readouterr().out)["passed"]
    assert cli.main([*base, "--max-route-accuracy-drop", "0.11", "--max-argument-accuracy-drop", "0.11", "--route-accuracy", "0.85"]) == 1
    capsys.readouterr()
    assert cli.main([x.replace("new.yaml", "old.yaml") for x in base]) == 1 and "no route was added" in capsys.readouterr().err
