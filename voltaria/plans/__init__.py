"""The library's models, by domain. Importing this package registers all of them."""

from . import community, flexibility, forecasts, grid, invariants, retention, rooftops, weather  # noqa: F401
