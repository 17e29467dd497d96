"""Vectors with every kind of odd row."""

import numpy as np

SF = "/root/testdata/sf0.001"


def vectors(spark):
    r = np.random.default_rng(5)
    rows = []
    for i in range(120):
        v = r.standard_normal(6)
        rows.append((i, v.tolist(), int(i % 3)))
        if i % 4 == 0:
            rows.append((1000 + i, (v + 0.05 * r.standard_normal(6)).tolist(), int(i % 3)))
            rows.append((2000 + i, (v * 3).tolist(), int(i % 3) if i % 8 else None))
    rows += [(3000, None, 1), (3001, [], 1), (3002, [0.0] * 6, 1), (3003, [float("nan")] + [1.0] * 5, 1),
             (3004, [float("inf")] + [1.0] * 5, 1), (3005, [None] + [1.0] * 5, 1), (3006, [1.0, 2.0], 1),
             (3007, [1.0, 2.1], 1), (None, [1.0] * 6, 1), (100, rows[100][1], rows[100][2]), (3100, [1.0] * 6, None)]
    rows += [rows[5], rows[5]]
    return spark.createDataFrame([(*x, "clash", "clash") for x in rows],
                                 "vec_id long, embedding array<double>, label int, id string, v string")
