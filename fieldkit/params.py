"""Default parameters of the operators.

Fixed values (must equal the source behaviour for identical results):
  trip clustering radius 1 km; home/work clustering radius 2 km;
  stay threshold 15 minutes (shorter stays are stops);
  stay time of the last cluster of a day 1440 minutes;
  home/work share threshold 0.60; consistency threshold 5 events per day;
  Earth radius 6371 km (haversine) and 6378.388 km (Hayford ellipsoid);
  weekday numbers 5 and 6 (Saturday, Sunday) are the weekend;
  random forest: 3 trees, depth 4, 32 bins, gini; split 70/30; sample 0.5.
Hour lists of the test fixture (FIXTURES.md):
  home 20, 21, 22, 23, 0, 1, 2, 3, 4, 5, 6; work 8..17; transit 7, 18, 19;
  days excluded from home/work counting: Saturday, Sunday.
"""

TRIP_RADIUS_KM = 1.0
HOME_WORK_RADIUS_KM = 2.0
STAY_THRESHOLD_MIN = 15
LAST_STAY_MIN = 1440
HOME_WORK_SHARE = 0.60
EVENTS_PER_DAY_THRESHOLD = 5
EARTH_RADIUS_KM = 6371.0
HAYFORD_RADIUS_KM = 6378.388
WEEKEND_FROM = 5

HOME_HOURS = (20, 21, 22, 23, 0, 1, 2, 3, 4, 5, 6)
WORK_HOURS = (8, 9, 10, 11, 12, 13, 14, 15, 16, 17)
TRANSIT_HOURS = (7, 18, 19)
EXCLUDED_DAYS = ("Saturday", "Sunday")

RF_NUM_TREES = 3
RF_MAX_DEPTH = 4
RF_MAX_BINS = 32
RF_SEED = 42
SPLIT_WEIGHTS = (0.7, 0.3)
SAMPLE_FRACTION = 0.5

# travel-day test (MB-4): at least this many unique locations and a farthest
# pair at least this far apart
MIN_UNIQUE_LOCS = 2
DISTANCE_THRESHOLD_KM = 1.0
