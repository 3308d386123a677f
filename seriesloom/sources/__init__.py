"""Reading inputs and writing forecasts."""

from .files import read_csv, write_forecast

__all__ = ["read_csv", "write_forecast"]
