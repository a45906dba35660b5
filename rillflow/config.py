"""Constants of the engine, in one place. All are defaults of parameters: on other data they are configuration."""

#: Relative difference up to which two capacities count as the same, and days that an old value may linger at a season's start.
CAPACITY_EPS, EDGE_MAX_DAYS = 0.005, 2
#: Months of a season, inclusive; its first day is the first of the first month.
SEASON_MONTHS = (6, 10)
#: Consecutive evaluable days that make a crossover.
CROSSOVER_MIN_RUN = 5
#: Bands of the two-axis classification: percent of rain, points of storage.
RAIN_BAND, STORAGE_BAND = 20.0, 10.0
#: Cusec-days to million cubic metres; the season's integral uses the shorter constant.
CUSEC_DAY_MCM, CUSEC_DAY_MCM_INTEGRAL = 0.00244658, 0.0024466
#: Gate limits in percent: falls, disagreements between statements, broken steps.
MAX_BACKWARD_PCT, MAX_DISAGREE_PCT, MAX_STEP_BREAK_PCT = 0.10, 0.10, 1.00
#: Absolute tolerances: fall of a running total, step identity.
FALL_TOLERANCE, STEP_TOLERANCE = 0.001, 1.001
#: Days without a newer load before it counts as stale.
MAX_STALE_DAYS = 3
#: Consecutive failures before a pause.
FAILURE_RUN = 6
#: Expected entities in a daily report; each published figure is rounded by at most half of one hundredth.
EXPECTED_ENTITIES, ROUNDING = 206, 0.005
#: Weights of the composite index.
INDEX_WEIGHTS = {"diversity": 0.50, "source": 0.35, "size": 0.15}
#: Quantile at and above which a unit is in the top decile.
TOP_DECILE = 0.90
#: Thresholds of entity resolution: capacity, sub-district likeness, name likeness, kilometres from an outline.
CAP_OK, SUBDISTRICT_OK, NAME_OK, NEAR_KM = 0.10, 0.85, 0.86, 7.0
#: Kilometres of a degree along the equator and along a meridian; degrees by which outlines are widened.
KM_PER_DEGREE, KM_PER_DEGREE_NORTH, OUTLINE_BUFFER = 111.32, 110.57, 0.01


def residual_tolerance(entities: int = EXPECTED_ENTITIES) -> float:
    """What rounding alone can make of the difference between a printed total and the sum of its parts, both ways."""
    return 2 * entities * ROUNDING
