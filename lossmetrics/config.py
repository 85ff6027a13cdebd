"""Default parameters. Every operator takes these as arguments; nothing reads a clock or the environment."""

import datetime

# The published defaults of the analyses.
PAID_CAP = 5_000_000.0
SLA_DAYS = (90, 180, 365)
FORECAST_PERIODS = 12
CONTAMINATION = 0.05
SEED = 42

# Stands in for "today" wherever an age or a future date is measured.
AS_OF = datetime.date(2001, 6, 30)
