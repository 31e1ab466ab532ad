"""Parameters of the registered queries, shared by the Spark plans and their
SQL oracles so that both sides compute the same thing.

The reference's literal limits (15 s windows, 2 s disorder, 60 s timeouts,
amounts 1.00 / 500.00) are the library defaults; the stored ``events`` table
has one event per ~4 minutes and amounts up to ~490, so the registered queries
scale the limits to that data (SURVEY 7.4).
"""

SEC = 1000
MIN = 60 * SEC
HOUR = 60 * MIN
DAY = 24 * HOUR

HOURLY = "1 hour"                 # J8 / J9 window
HOURLY_MS = HOUR
MIN_WINDOW = "15 minutes"         # J3 window-min and J5 top-N windows
MIN_WINDOW_MS = 15 * MIN
TOP_N = 3
MONEY = 2                         # decimals of the stored amounts; results are rounded to them

LATE_SIZE_MS = 15 * MIN           # J4 replay: window, disorder bound, lateness
LATE_DELAY_MS = HOUR
LATE_LATENESS_MS = 30 * MIN

FRAUD_SMALL = 5.0                 # J2: small-then-large within a day
FRAUD_LARGE = 100.0
FRAUD_WITHIN_MS = DAY

SILENCE_SHORT_MS = MIN            # J6 inactivity timer
SILENCE_LONG_MS = HOUR
SESSION_GAP_MS = HOUR             # per-session form of J6

LONG_RIDE_MS = 1000 * DAY         # J11 threshold for day-granular ride data
END_BEFORE_START_MS = 3650 * DAY  # streaming J11: how early an END may precede its START
MATCH_TIMEOUT_MS = HOUR           # J7 timeout on the tagged events stream
MATCH_RIDE_TYPE = "click"
MATCH_FARE_TYPE = "purchase"

BOUNDED_BEGIN = "2024-01-01 00:00:00"   # SRC-8 time-bounded scan
BOUNDED_DAYS = 7

NEAR_LON = -73.985                # GEO-6 reference point and radius (km)
NEAR_LAT = 40.758
NEAR_RADIUS = 5.0
HEADING_SECTOR_DEG = 45
