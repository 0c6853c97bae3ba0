"""Byte-range JSON reading against the whole-file reader."""

import json
import os
import random

import pytest

from permscope.session import apply_engine_conf
from permscope.sources import acl_json as AJ
from permscope.sources import json_split as JS


class Bytes:
    """A file in memory."""

    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at:at + n]


def value(rng, depth):
    k = rng.random()
    if depth > 3 or k < 0.3:
        return rng.choice(['a"b', "\\", '\\\\"', "[{", "}]", 1, None, True, "é日", "x" * rng.randint(0, 30)])
    if k < 0.6:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return {rng.choice(["a", '"k"', "[", "}"]): value(rng, depth + 1) for _ in range(rng.randint(0, 4))}


def split(data, size):
    """(good, bad flags, records) of a file read in ranges of ``size`` bytes."""
    import pyarrow as pa

    f, rows = Bytes(data), []
    for s in range(0, max(len(data), 1), size):
        e = min(s + size, len(data))
        state = {x: (*x, 0) for x in JS._STATES}
        for _, block in JS._blocks(f, s, e):
            for x, (escape, inside, depth) in list(state.items()):
                _, step, pending, now = JS.scan(block, escape, inside)
                state[x] = (pending if now else 0, now, depth + int(step.sum()))
        rows.append({"source_file": "f", "start": s, "end": e, "states": [v for x in JS._STATES for v in state[x]],
                     "head": list(JS._head(f)) if s == 0 else None})
    starts = JS._starts(pa.Table.from_pylist(rows)).to_pylist()
    found = [x for r in starts for x in JS._records_of(f, r)] if starts[0]["good"] else []
    return starts[0]["good"], any(bad for bad, _ in found), [t for bad, t in found if not bad]


def test_any_cut_gives_the_same_records(monkeypatch):
    rng = random.Random(0)
    for t in range(400):
        doc = [value(rng, 1) for _ in range(rng.randint(0, 8))] if t % 5 else {"a": value(rng, 1), "b": [value(rng, 1)]}
        text = rng.choice(["", " \n", "﻿"]) + json.dumps(doc, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        monkeypatch.setattr(JS, "STEP", rng.choice([1, 2, 3, 7, 64, 1 << 20]))
        good, bad, got = split((text + rng.choice(["", " \n"])).encode(), rng.choice([1, 2, 5, 17, 100, 10**6]))
        assert good and not bad
        assert [json.loads(x) for x in got] == ([x for x in doc if isinstance(x, (dict, list))] if isinstance(doc, list) else [doc])


@pytest.mark.parametrize("text", ['[{"a":1}] x', '[{"a":1}][{"b":2}]', '[{"a":1}', '{"a":[}', "", "  ", '"s"', "[1]}{", "{} {}", '[{"a":"]}'])
def test_broken_files_show(monkeypatch, text):
    for size in (1, 3, 100):
        for step in (1, 5, 100):
            monkeypatch.setattr(JS, "STEP", step)
            good, bad, _ = split(text.encode(), size)
            assert not good or bad


@pytest.mark.parametrize("size", [37, 1 << 20])
def test_equals_the_whole_file_reader(spark, tmp_path, size):
    apply_engine_conf(spark)
    rng = random.Random(size)
    folder = tmp_path / "run-1" / "folderacls"
    os.makedirs(folder)

    def record(k):
        return {"UncPath": f"\\\\h\\s\\f{k}", "Owner": 'a "b" [é] {', "Access": [
            {"Identity": f"DOM\\u{rng.randint(0, 9)}", "Sid": "S-1", "Rights": "Read", "IsInherited": rng.random() < 0.5}
            for _ in range(rng.randint(0, 3))], "Extra": {"acl": [{"name": "inner ]["}]} if k % 3 else None}

    files = {"a.json": json.dumps([record(k) for k in range(20)]), "b.json": json.dumps(record(1), indent=2),
             "c.json": "﻿" + json.dumps([record(k) for k in range(5)], ensure_ascii=False, indent=1), "empty.json": "", "list.json": "[]",
             "bad.json": json.dumps([record(1)])[:-5], "two.json": json.dumps([record(1)]) + " {}", "inside.json": '[{"acl": [{"name": "x"}]}, {"a" 1}]',
             "my schema.json": "[]", "sp ace.json": json.dumps([record(7)])}
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")
    whole = AJ.read_folderacl_files(spark, str(tmp_path))
    records, quarantine = JS.read_split_records(spark, str(tmp_path), range_bytes=size)
    stem = lambda p: p.rsplit("/", 1)[1].replace("%20", " ")

    def aces(files):
        rows = AJ.nodes_to_aces(AJ.acl_nodes(files)).collect()
        return sorted(repr((r.run_id, stem(r.source_file), r.unc_path, r.folder_path, r.ace_name, r.ace_raw, r.ace_inherited, r.owner)) for r in rows)

    assert aces(records) == aces(whole)
    assert sorted(stem(r.source_file) for r in quarantine.collect()) == sorted(stem(r.source_file) for r in AJ.malformed_files(whole).collect())
