"""Registered queries run their operators at full extent."""
import pytest

from keepwell.operators import cluster, models
from keepwell.plans import catalog, observational


class Called(Exception):
    pass


def caught(monkeypatch, module, name, query):
    """Arguments of the call of an operator that a query makes."""
    def stop(*args, **kwargs):
        raise Called(args, kwargs)
    monkeypatch.setattr(module, name, stop)
    with pytest.raises(Called) as got:
        query(None, "")
    return got.value.args


@pytest.mark.parametrize("query", [catalog.kmeans_sweep, catalog.kmeans_choice])
def test_sweeps_cover_all_k_with_all_starts(monkeypatch, query):
    from unittest.mock import MagicMock
    monkeypatch.setattr(catalog, "labelled_points", lambda *_: MagicMock())
    args, kwargs = caught(monkeypatch, cluster, "sweep_k", query)
    assert kwargs == {"restarts": 20} and len(args) == 1 and list(cluster.K_RANGE) == list(range(2, 11))


def test_labels_and_resamples_use_all_starts(monkeypatch):
    from unittest.mock import MagicMock
    monkeypatch.setattr(catalog, "labelled_points", lambda *_: MagicMock())
    monkeypatch.setattr(catalog, "for_iteration", lambda df: df)
    args, kwargs = caught(monkeypatch, cluster, "fit_kmeans", catalog.kmeans_assign)
    assert kwargs["restarts"] == 20
    monkeypatch.setattr(catalog, "kmeans_labels", lambda *_: (None, None, None))
    monkeypatch.setattr(cluster, "second_opinion", lambda *_: None)
    args, kwargs = caught(monkeypatch, cluster, "resample_agreement", catalog.resample_stability)
    assert len(args) == 3 and not kwargs


@pytest.mark.parametrize("query, draws", [(catalog.observational_run, 200), (catalog.mediator_sensitivity, 50)])
def test_observational_runs_have_intervals(monkeypatch, query, draws):
    monkeypatch.setattr(catalog, "observational", lambda *_: None)
    assert caught(monkeypatch, observational, "run_observational", query)[1]["draws"] == draws


def test_tree_queries_use_the_whole_search(monkeypatch):
    monkeypatch.setattr(catalog, "splits", lambda *_: (None, None, None))
    space = models.search_space(50, catalog.SEED)
    assert caught(monkeypatch, models, "search_trees", catalog.param_search)[0][2] == space
    assert caught(monkeypatch, models, "fit_trees", catalog.tree_contributions)[1] == {"maxDepth": 5, "maxIter": 500}


def test_train_compare_fits_four_candidates(monkeypatch):
    fitted = []
    monkeypatch.setattr(catalog, "splits", lambda *_: (None, None, None))
    monkeypatch.setattr(models, "tree_matrix", lambda *_: "matrix")
    monkeypatch.setattr(models, "search_trees", lambda t, v, space, matrix: (None, space[7]))
    monkeypatch.setattr(models, "fit_linear", lambda *_: "linear")
    monkeypatch.setattr(models, "fit_trees", lambda t, v, name, matrix, **p: fitted.append(p) or name)
    got = caught(monkeypatch, models, "candidate_metrics", catalog.train_compare)[0][0]
    assert got == ["linear", "boosted_trees", "boosted_trees_deep", "boosted_trees_tuned"]
    assert fitted == [models.FIRST_TREES, models.SECOND_TREES, models.search_space(seed=catalog.SEED)[7]]
