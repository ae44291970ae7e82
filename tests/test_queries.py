"""Every registered query: values against SQL, or its properties where SQL cannot say."""

import compare
import pytest

import __spark_entry__ as entry
from ontime.queries import ORACLE, QUERIES, stages

CHECKED = sorted(ORACLE)
UNCHECKED = sorted(set(QUERIES) - set(ORACLE))


@pytest.fixture(scope="module")
def sql(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("key", CHECKED)
def test_same_rows_as_sql(spark, sf_dir, sql, key):
    assert compare.difference(QUERIES[key](spark, sf_dir), sql, ORACLE[key]) is None


@pytest.mark.parametrize("key", UNCHECKED)
def test_has_rows(spark, sf_dir, key):
    assert QUERIES[key](spark, sf_dir).count() > 0


def test_entry_counts_late_flights(spark):
    rows = {r.label: r.n for r in entry.entry(spark).collect()}
    assert set(rows) == {0, 1} and sum(rows.values()) == 5746


def test_every_sql_text_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_approximate_summary_is_near_the_exact_one(spark, sf_dir):
    from ontime.operators import describe_numeric

    table = stages.feature_table(spark, sf_dir)
    exact = {r["column"]: r for r in describe_numeric(table).collect()}
    for row in describe_numeric(table, approx=True).collect():
        assert row["n_values"] == exact[row["column"]]["n_values"]
        for mark in ("p25", "p50", "p75"):
            spread = exact[row["column"]]["max"] - exact[row["column"]]["min"]
            assert abs(row[mark] - exact[row["column"]][mark]) <= 0.01 * spread + 1


def test_chi_square_of_vector_slots_agrees_with_counts(spark, sf_dir):
    """The vector test and the count-based tests give the same statistics."""
    from ontime import config
    from ontime.operators import chi_square_named, chi_square_onehot, chi_square_table
    from ontime.operators.encode import scaled_name

    train = stages.parts(spark, sf_dir)[0]
    slots = {r.feature: r for r in chi_square_named(stages.trusted(spark, sf_dir)[0]).collect()}
    categories = [*config.STRING_CATEGORIES, *config.INTEGER_CATEGORIES]
    checked = 0
    for row in chi_square_onehot(train, categories).collect():
        assert slots[row.feature].statistic == pytest.approx(row.statistic, abs=1e-6)
        assert slots[row.feature].dof == row.dof
        checked += 1
    assert checked > 100
    for row in chi_square_table(train, config.CONTINUOUS_COLUMNS).collect():
        slot = slots[f"{scaled_name(row['column'])}_0"]
        assert slot.statistic == pytest.approx(row.statistic, rel=1e-9)
        assert slot.dof == row.dof


def test_slots_without_rows_are_never_significant(spark, sf_dir):
    from ontime.operators import chi_square

    rows = chi_square(stages.trusted(spark, sf_dir)[0]).filter("dof = 0").collect()
    assert len(rows) == 10 and all(r.statistic == 0 and r.p_value == 1 for r in rows)


def test_grid_covers_every_combination(spark, sf_dir):
    from ontime.operators import best_params, grid_scores

    search = stages.search(spark, sf_dir)
    rows = grid_scores(search).collect()
    assert len({r.params for r in rows}) == 12
    assert all(0 <= r.metric <= 1 for r in rows)
    assert best_params(search).first().metric == max(r.metric for r in rows)


def test_binned_and_exact_areas_agree(spark, sf_dir):
    from ontime.operators import auc, auc_exact, predict, with_score

    predictions = predict(stages.search(spark, sf_dir), stages.trusted(spark, sf_dir)[1])
    assert auc(predictions) == pytest.approx(auc_exact(with_score(predictions)).first().auc, abs=2e-3)


def test_models_beat_chance(spark, sf_dir):
    from ontime.operators import compare_models, predict

    test = stages.trusted(spark, sf_dir)[1]
    models = {"logistic": stages.logistic, "tuned_logistic": stages.search, "forest": stages.forest}
    rows = compare_models({name: predict(fit(spark, sf_dir), test) for name, fit in models.items()}).collect()
    assert {r.model for r in rows} == set(models)
    assert all(r.auc > 0.55 for r in rows)


def test_importances_sum_to_one(spark, sf_dir):
    from ontime.operators import named_importances

    rows = named_importances(stages.forest(spark, sf_dir), stages.trusted(spark, sf_dir)[0]).collect()
    assert sum(r.importance for r in rows) == pytest.approx(1.0)


def test_top_and_bottom_coefficients(spark, sf_dir):
    from ontime.operators import named_coefficients, top_bottom

    named = named_coefficients(stages.search(spark, sf_dir).bestModel.stages[0], stages.trusted(spark, sf_dir)[0])
    rows = top_bottom(named, "coefficient", 10, "name").collect()
    top = [r.coefficient for r in rows if r.side == "top"]
    bottom = [r.coefficient for r in rows if r.side == "bottom"]
    assert len(top) == len(bottom) == 10 and min(top) >= max(bottom)
