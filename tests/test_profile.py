"""The profile against a brute-force one over random ragged sheets."""

import random
from collections import Counter
from datetime import datetime

import pytest
from books import grid, sheet, tag

from tallyloom.operators import profile

VALUES = [None, None, None, 1, 2, 1.0, True, "x", " x", "", "=A1", " =B2", datetime(2024, 1, 1), "null", "a|b", '","']


def random_rows(seed):
    rng = random.Random(seed)
    rows = [
        [rng.choice(VALUES) for _ in range(rng.randint(0, 4))] for _ in range(rng.randint(1, 30))
    ]
    return rows + [list(rng.choice(rows)) + [None] * rng.randint(0, 2) for _ in range(10)]


def brute(rows):
    width = max(len(r) for r in rows)
    padded = [list(r) + [None] * (width - len(r)) for r in rows]
    head = next((i for i, r in enumerate(padded) if sum(v is not None for v in r) >= 2), 0)
    data = padded[head + 1 :]
    columns, issues = [], []
    for i in range(width):
        values = [r[i] for r in data if r[i] is not None]
        kinds = Counter(tag(v) for v in values)
        formulas = kinds.pop("formula", 0)
        name = f"col_{i}" if padded[head][i] is None else str(padded[head][i]).strip()
        nulls = len(data) - len(values)
        pct = int(nulls * 1000 / len(data) + 0.5) / 10 if data else 0
        top = kinds.most_common(1)[0][0] if kinds else "unknown"
        columns.append((i, name, nulls, pct, len(values), top, dict(kinds), formulas))
        if len(kinds) > 1:
            issues.append(f"Column '{name}': mixed types {dict(kinds)}")
        if pct > 50:
            issues.append(f"Column '{name}': {pct}% null")
        if formulas:
            issues.append(
                f"Column '{name}': {formulas} formula cell(s) (data_only=True may suppress values)"
            )
    filled = [r for r in data if any(v is not None for v in r)]
    repeats = sum(n - 1 for n in Counter(str(r) for r in filled).values())
    if repeats:
        issues.append(f"{repeats} duplicate data row(s) detected")
    return columns, len(data), len(filled), repeats, issues


@pytest.mark.parametrize("limit", [None, 0])
def test_against_brute_force(spark, limit, monkeypatch):
    if limit == 0:
        # The way taken when facts are too large to broadcast, with blocks of two rows.
        monkeypatch.setattr("tallyloom.operators.scale.BROADCAST_BYTES", -1)
        monkeypatch.setattr("tallyloom.operators.scale.BLOCK_BITS", 1)
    books = {f"s{seed}": random_rows(seed) for seed in range(12)}
    g = grid(spark, *[sheet(n, rows, idx=i) for i, (n, rows) in enumerate(books.items())])
    for parts in (1, 7):
        p = profile.Profile(g.repartition(parts))
        columns = p.columns.orderBy("sheet", "col_idx").collect()
        reports = {r.sheet: r for r in p.sheets.collect()}
        issues = p.issues.orderBy("sheet", "issue_no").collect()
        for name, rows in books.items():
            want, total, filled, repeats, texts = brute(rows)
            got = [
                (c.col_idx, c.column, c.null_count, c.null_pct, c.non_null_count, c.dominant_type,
                 c.type_distribution, c.formula_cells)
                for c in columns
                if c.sheet == name
            ]
            assert got == want
            r = reports[name]
            assert (r.total_data_rows, r.non_empty_data_rows, r.duplicate_row_count, r.issue_count) == (
                total, filled, repeats, len(texts)
            )
            assert r.flag == ("OK" if not texts else f"! {len(texts)} issue(s)")
            assert [i.issue for i in issues if i.sheet == name] == texts
        assert p.sources.first().total_issues == len(issues)


def test_empty_sheet_is_reported(spark):
    g = grid(spark, sheet("s", [("a", "b"), (1, 2)]))
    listed = spark.createDataFrame(
        [("book", "s", 0), ("book", "none", 1)], "source_id string, sheet string, sheet_idx bigint"
    )
    p = profile.Profile(g, sheets=listed)
    row = p.sheets.filter("sheet = 'none'").first()
    assert row.error == "empty sheet" and row.issue_count is None and row.flag == "OK"
    assert p.sources.first().sheet_count == 2


@pytest.mark.parametrize("limit", [None, 0])
def test_one_pass_equals_two(spark, limit):
    books = {f"s{seed}": random_rows(seed) for seed in range(12)}
    g = grid(spark, *[sheet(n, rows, idx=i) for i, (n, rows) in enumerate(books.items())])
    facts = profile.profile_facts(g)
    tallies = profile.row_tallies(g, facts, limit)

    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    assert rows(tallies.drop("repeats")) == rows(profile.cell_tallies(g, facts))
    assert rows(profile.tallied_duplicates(tallies)) == rows(profile.duplicate_rows(g, facts))


def test_one_pass_scans_the_grid_once(spark, tmp_path):
    g = grid(spark, sheet("s", [["a", "b"], [1, 2], [1, 2], [None, None]]))
    g.write.parquet(str(tmp_path / "grid"))
    stored = spark.read.schema(g.schema).parquet(str(tmp_path / "grid"))
    tallies = profile.row_tallies(stored, profile.profile_facts(stored))
    plan = tallies._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("cells#") and plan.count("Join") == 1 and plan.count("parquet") == 2  # the grid and the facts
