"""Fixed values of the layers: label bounds, category words and defaults.

The results of the layers depend on these exact values.
"""

# traffic_level: vehicles per hour, first bound above the value
TRAFFIC_LEVELS = [(1000, "Low"), (3000, "Medium"), (5000, "High")]
TRAFFIC_LEVEL_TOP = "Very High"
TRAFFIC_VOLUME_RANGE = (0, 100000)

# temperature_category: degrees Celsius, first bound reached
TEMPERATURE_CATEGORIES = [(35, "Extreme Heat"), (25, "Warm"), (10, "Mild"), (0, "Cool")]
TEMPERATURE_CATEGORY_BOTTOM = "Cold"
KELVIN_OFFSET = 273.15
STAGING_TEMPERATURE_DEFAULT = 20.0
PRESSURE_DEFAULT = 1013

# city_size_category: inhabitants, first bound above the value
CITY_SIZES = [(100000, "Small"), (500000, "Medium"), (1000000, "Large")]
CITY_SIZE_TOP = "Mega"
MEDIAN_AGE_DEFAULT = 35.0
HOUSEHOLD_SIZE_DEFAULT = 2.5

# event_category: words looked for in the event type, in this order
EVENT_CATEGORIES = [
    ("TRAFFIC", ("traffic", "vehicle")),
    ("PEDESTRIAN", ("pedestrian",)),
    ("AIR_QUALITY", ("air", "quality")),
    ("ORDER", ("order",)),
]
EVENT_CATEGORY_OTHER = "OTHER"

NO_HOLIDAY = "None"
UNKNOWN = "Unknown"
HAZARDOUS_AQI = 300

# urban_health_score = 100 - mean AQI / 10, plus a weekend bonus, held in 0..100
HEALTH_SCORE_RANGE = (0.0, 100.0)
HEALTH_SCORE_AQI_DIVISOR = 10.0
HEALTH_SCORE_WEEKEND_BONUS = 5.0
