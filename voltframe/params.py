"""Parameters of the hourly spike-forecasting workload.

Values in the FIXED VALUES block must equal the modelled workload's values for
results to agree (thresholds, horizons, grids, percentiles, split bounds).
The stand-in block maps those roles onto the driver's synthetic tables.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the modelled workload)
# ---------------------------------------------------------------------------
SPIKE_THRESHOLD = 200.0          # price > 200 is a spike (strict)
HORIZON = 2                      # predict spike at t + 2
SEASONAL_PERIOD = 24             # seasonal naive uses lag 24 - horizon = 22
LEAD_LAG_HOURS = 24              # spike_lead_1..24 and spike_lag_1..24
PRICE_LAGS = (1, 6, 24)          # price_lag_{1,6,24}h
ROLLING_WINDOW = 6               # shift(1).rolling(6).mean()
NET_LOAD_DIFF = 3                # net_load_3h_change
LAG_HOURS = (1, 6, 24)           # multi-source lags
CHANGE_HOURS = (1, 24)           # multi-source differences
SOLAR_DEAD_BAND = 0.5            # solar below 0.5 MW -> 0
CLOCK_SHIFT_HOURS = -7           # UTC -> market time, constant offset
YEAR_PERIOD_DAYS = 365
HIST_CLIP_UPPER = 800.0          # price clipped at 800 for the histogram
HIST_BINS = 80
DESCRIBE_PERCENTILES = (0.5, 0.9, 0.95, 0.99, 0.999)
REPORT_QUANTILES = (0.5, 0.75, 0.9, 0.95, 0.99, 0.999)
CV_SPLITS = 5
# Threshold grids: (start, stop, count) as in linspace / arange.
GRID_BASELINE = (0.05, 0.99, 95)   # linspace(0.05, 0.99, 95)
GRID_PIPELINE = (0.10, 0.90, 81)   # linspace(0.10, 0.90, 81)
GRID_CNN = (0.05, 0.94, 90)        # arange(0.05, 0.95, 0.01)
VIF_LIMIT = 10.0
VIF_MIN_FEATURES = 5
ADF_CRITICAL_5PCT = -2.86
KPSS_CRITICAL_5PCT = 0.463
# Quality report bounds of the merge step (rows, spike hours).
QUALITY_ROWS = (40_000, 55_000)
QUALITY_SPIKE_HOURS = (2_000, 4_000)
# Reference event calendar (inclusive date ranges).
REFERENCE_EVENT_RANGES = (
    ("2021-07-09", "2021-07-18"),
    ("2022-07-08", "2022-07-17"),
    ("2023-07-07", "2023-07-16"),
    ("2024-07-05", "2024-07-14"),
    ("2025-07-04", "2025-07-13"),
)
REFERENCE_FUEL_TYPES = ("COAL", "DUAL FUEL", "ENERGY STORAGE", "GAS", "HYDRO",
                        "OTHER", "SOLAR", "WIND")
REFERENCE_SPLITS = ("2023-11-06 00:00:00", "2024-12-12 00:00:00")
# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

# Stand-in mapping on the driver's tables (FIXTURES.md B1-B4).
FUEL_MAP = {            # events.event_type -> fuel
    "click": "gas",
    "view": "wind",
    "purchase": "solar",
    "signup": "hydro",
    "error": "coal",
}
FUELS = tuple(FUEL_MAP.values())
DISPATCHABLE = ("coal", "gas", "hydro")
RENEWABLE = ("wind", "solar")
HOURLY_SPLITS = ("2024-01-19 00:00:00", "2024-01-25 00:00:00")
HOURLY_EVENT_RANGES = (("2024-01-05", "2024-01-08"), ("2024-01-19", "2024-01-21"))
DAILY_SPLITS = ("1999-01-01 00:00:00", "2000-07-01 00:00:00")
DAILY_SPIKE_THRESHOLD = 460000.0
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PROB_SCALE = 800.0      # y_prob = round(load / (load + 800), 2)

BASE_COLUMNS = ("price", "load", *[f"{f}_total" for f in FUELS],
                *[f"{f}_cap" for f in FUELS], "imp", "exp")
LAG_SOURCES = ("price", "load", "wind_total", "solar_total", "gas_total",
               "renewable_generation", "net_load", "reserve_margin")
CHANGE_SOURCES = ("load", "wind_total", "solar_total", "gas_total", "net_load",
                  "reserve_margin")
CYCLICAL = ("sin_day", "cos_day", "sin_week", "cos_week",
            "sin_year_1", "cos_year_1", "sin_year_2", "cos_year_2")
BINARY = ("is_weekend", "is_event")
