"""Sinks: tables, the feature list, the model, forecasts."""

from shopcast.sinks.tables import (  # noqa: F401
    write_table, write_features, read_features, save_model, load_model,
    write_categories, read_categories, write_forecast, forecast_tags)
