from __future__ import annotations

import numpy as np
import pytest
from llm_support import union_find

from tallyloom.llm import embedding_dedup
from tallyloom.llm.embedding_dedup import compare_blocks, near_vectors


def brute_force(rows, threshold=0.98):
    usable = [
        i for i, (vec_id, v, label) in enumerate(rows)
        if vec_id is not None and label is not None and v is not None
        and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links, edges = dict.fromkeys(range(len(rows)), 0), []
    for i in usable:
        for j in usable:
            if i != j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    edges.append((rows[i][0], rows[j][0]))
    component = union_find({r[0] for r in rows if r[0] is not None}, edges) | {None: None}
    return sorted(str((r[0], links[i], component[r[0]], component[r[0]] == r[0])) for i, r in enumerate(rows))


@pytest.mark.parametrize("block", [512, 4])
def test_links_and_components(spark, block):
    random = np.random.default_rng(4)
    rows = []
    for cluster in range(12):
        centre = random.standard_normal(16)
        for _ in range(12):
            noisy = centre + random.standard_normal(16) * random.choice([0.02, 0.05])
            rows.append((len(rows), noisy.astype(np.float32).tolist(), cluster % 3))
    same = rows[5][1]
    rows += [(1000 + i, same, 1) for i in range(9)] + [(1100, [2 * x for x in same], 1), (1101, same, None)]
    rows += [(1200, None, 1), (1201, [], 1), (1202, [0.0] * 16, 1), (1203, [float("nan")] * 16, 1)]
    rows += [(1204, [None] * 16, 1), (1205, [float("inf")] * 16, 1), (None, same, 1), (1206, same[:8], 1)]
    rows += [(1207, [1e-30] * 16, 1), (1208, [1e30] * 16, 1), (3, rows[3][1], 0)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    frame = frame.withColumn("node", frame["vec_id"]).withColumn("codes", frame["label"])
    found = near_vectors(frame, tables=24, planes=8, block=block).collect()
    single = [(r[0], None if r[1] is None else [None if x is None else float(np.float32(x)) for x in r[1]], r[2]) for r in rows]
    assert sorted(str(tuple(r)) for r in found) == brute_force(single)


def test_slices_of_a_block_give_every_pair_once(monkeypatch):
    random = np.random.default_rng(2)
    left, right = random.standard_normal((23, 3)), random.standard_normal((17, 3))
    codes = random.integers(0, 3, (40, 4))
    for other in (None, right):
        found = []
        for size in (5, 512):
            monkeypatch.setattr(embedding_dedup, "SLICE", size)
            rows = compare_blocks(left, other, codes[:23], None if other is None else codes[23:], 2, 0.5)
            found.append(sorted(zip(*(column.tolist() for column in rows))))
        assert found[0] == found[1] and len(found[0]) > 20
        assert len({pair[:2] for pair in found[0]}) == len(found[0])
        assert other is not None or all(i < j for i, j, _ in found[0])


def test_empty_table(spark):
    nothing = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert near_vectors(nothing).collect() == []


@pytest.mark.parametrize(("kind", "labels"), [("string", ["a", "a", "b", None]), ("double", [1.2, 1.2, 1.7, None])])
def test_labels_of_any_type_are_compared_as_they_are(spark, kind, labels):
    rows = [(i, [1.0, 2.0], label) for i, label in enumerate(labels)]
    frame = spark.createDataFrame(rows, f"vec_id bigint, embedding array<float>, label {kind}")
    found = {row["vec_id"]: row["n_links"] for row in near_vectors(frame).collect()}
    assert found == {0: 1, 1: 1, 2: 0, 3: 0}
