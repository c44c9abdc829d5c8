import json
import random

import pytest

from sluice.operators import nested


def value(rng, depth):
    if depth == 0 or rng.random() < 0.3:
        return rng.choice([None, True, False, 0, -12, 1.5e-7, 10**20, "", 'q"\\\n\u00fc\ud83d\ude00', "[]", {}, []])
    if rng.random() < 0.5:
        return [value(rng, depth - 1) for _ in range(rng.randint(0, 4))]
    return {rng.choice("abcd") + str(k): value(rng, depth - 1) for k in range(rng.randint(0, 4))}


def test_deep_reader_reads_as_json_does():
    rng = random.Random(3)
    for _ in range(400):
        text = json.dumps(value(rng, 6), indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        assert nested.read_deep(text) == json.loads(text)
        at = rng.randrange(len(text))
        broken = text[:at] + rng.choice(["", ",", "]", "}", "x", '"', ":"]) + text[at + 1 :]
        try:
            expected = json.loads(broken)
        except ValueError:
            with pytest.raises(ValueError):
                nested.read_deep(broken)
        else:
            assert nested.read_deep(broken) == expected
    for bad in ("", " ", "NaN", "-Infinity", "[1,]", '{"a":1,}', "[" * 50_000, "01", "\ufeff1"):
        with pytest.raises(ValueError):
            nested.read_deep(bad)


def test_rows_of_a_record_of_any_depth(spark):
    depth = 30_000
    deep = '{"a": [{"n": 1}], "d": ' + "[" * depth + '{"m": 2}' + "]" * depth + "}"
    got = {(tuple(steps[:2]), kinds[-1], len(label), json.dumps(x)) for steps, kinds, label, x in nested.element_objects(deep)}
    assert got == {(("a", "0"), "o", 2, '{"n": 1}'), (("d", "0"), "o", depth + 1, '{"m": 2}')}
    rows = nested.element_nodes(spark.createDataFrame([("r", deep), ("s", deep[:-1])], "id string, x string"), ["id"], ["x"]).collect()
    assert sorted((r["id"], len(r["label"]), r["scalars"]) for r in rows) == [("r", 2, '{"n": 1}'), ("r", depth + 1, '{"m": 2}')]
