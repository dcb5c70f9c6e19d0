"""Registered model queries run at the operators' own sizes."""

import pytest

from gridlens import schemas
from gridlens.operators import detect, forecast
from gridlens.plans.catalog import REGISTRY


class Seen(Exception):
    pass


def _stop(*args, **kwargs):
    raise Seen(args, kwargs)


def test_boosted_load_is_fitted_on_all_features_at_full_size(views, monkeypatch):
    monkeypatch.setattr(forecast, "fit_boosted_load", _stop)
    with pytest.raises(Seen) as seen:
        REGISTRY["f1_fit_boosted_load"].build(views)
    (_, features), params = seen.value.args
    assert features == schemas.TREE_FEATURES and params == {}


@pytest.mark.parametrize("name, module, fit, copies", [
    ("f2_fit_graph_load", forecast, "fit_window_loads", 2),
    ("d1_fit_reconstruction", detect, "fit_reconstruction_blocks", 1),
    ("d2_reconstruction_score", detect, "fit_reconstruction_blocks", 1),
    ("x6_stream_anomaly", detect, "fit_reconstruction_blocks", 1)])
def test_windows_hold_all_load_features(views, monkeypatch, name, module, fit, copies):
    monkeypatch.setattr(module, fit, _stop)
    with pytest.raises(Seen) as seen:
        REGISTRY[name].build(views)
    (packed, features, *_), params = seen.value.args
    assert packed.seq_len == 24 and len(features) == copies * len(schemas.LOAD_FEATURES)
    assert set(features) <= set(packed.columns) and params == {}
