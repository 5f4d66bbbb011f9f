"""Fixed values of the domain. They must equal the published pipeline's for equal results."""

import datetime as dt

# Sensor kinds (30/60/90 cm suction tension and stem). Predictions reuse kind 4 for
# the mean over the depths.
SENSOR_TYPES = [
    (1, "saugspannung_30cm"),
    (2, "saugspannung_60cm"),
    (3, "saugspannung_90cm"),
    (4, "saugspannung_stamm"),
]
DEPTHS = [1, 2, 3]
DEPTH_LABELS = {1: "30 cm", 2: "60 cm", 3: "90 cm"}
DEPTH_MEAN_TYPE = 4

# Customers of the irrigation service.
CUSTOMERS = [(2, "Mitte"), (3, "Neukölln")]

# Weather tiles (id, lng, lat, ring of lon/lat corners).
WEATHER_TILES = [
    (2, 13.367615, 52.526836, [
        (13.309444, 52.572556), (13.425786, 52.572556), (13.425786, 52.472556),
        (13.309444, 52.472556), (13.309444, 52.572556),
    ]),
    (3, 13.447711, 52.448092, [
        (13.377733038944818, 52.49809199460378), (13.517688961055182, 52.4980919946037),
        (13.517532424761926, 52.39809199460377), (13.377876575238076, 52.39809199460377),
        (13.377733038944818, 52.49809199460378),
    ]),
]

# Kinds of issue a citizen can report (title, description, image).
ISSUE_TYPES = [
    ("Missnutzung der Baumscheibe",
     "Die Baumscheibe (nicht versiegelte Fläche) am Standort eines Baums wir oft durch falsch "
     "parkende Autos, illegalen Müll-Entsorgungen, wie bspw.: alte Waschmaschinen oder Bauschutt, "
     "missbraucht. Melde uns bitte, wenn die Baumscheibe seit längerem zugestellt ist.",
     "/images/issues/missnutzung-baumscheibe.jpg"),
    ("Baumschäden",
     "Baumschäden, wie bspw. abgeknickte Äste, stellen eine Gefahr für den Straßenraum dar und "
     "können die Vitalität eines Baumes nachhaltig einschränken. Melde uns bitte, wenn dieser "
     "Baum einen Schaden hat.",
     "/images/issues/baumschaeden.jpg"),
]

MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december"]
SEASONS = ["spring", "summer", "fall", "winter"]

# The station and tile whose series stand for the whole city.
CITY_STATION = 433
CITY_TILE = 2

SEASON_START = dt.date(2021, 6, 1)
WATERING_SEASON = (4, 10)   # months kept on the watering and tree-day spines
SENSOR_SEASON = (4, 9)      # months kept after filling sensor gaps; really one month shorter
WATERING_RESUME = dt.date(2021, 12, 31)

ROLLING_ROWS = 7
TRAILING_ROWS = 14
FILL_DAYS = 7
HORIZON_DAYS = 14
LAGS = 3
SEASON_START_LAG = 20.0

# Sub-window of the 900 x 900 rain lattice (corner bounds, upper bound exclusive).
LATTICE_X = (600, 700)
LATTICE_Y = (700, 800)

# Age and bed-area classes, right-closed (lower, upper, label).
AGE_BINS = [(0, 3, "jung"), (3, 10, "mittel"), (10, 100, "alt")]
BED_BINS = [(0, 5, "klein"), (5, 100, "groß")]

# Model inputs, in the order the models take them.
NOWCAST_FEATURES = ["month", "gattung", "standalter", "water_sga", "water_gdk", "shading_index",
                    "wind_max_ms", "rainfall_mm", "temp_avg_c", "ghi_sum_whm2", "mean_yesterday"]
FORECAST_FEATURES = ["month", "gattung", "standalter", "shading_index", "wind_max_ms",
                     "temp_avg_c", "rainfall_mm", "ghi_sum_whm2", "mean_yesterday"]
LAG_FEATURES = ["shift_1", "shift_2", "shift_3"]
CATEGORICAL = ["month", "gattung", "standalter", "baumscheibe_m2", "baumscheibe_surface"]
NUMERIC = ["value", "water_gdk", "water_sga", "shading_index", "mean_yesterday", "site_id"]
IMPUTED = ["baumscheibe_m2", "baumscheibe_surface", "water_sga", "water_gdk"]
STATION_WEATHER = ["wind_max_ms", "wind_avg_ms", "rainfall_mm", "temp_max_c", "temp_avg_c", "upm"]
TILE_WEATHER = ["wind_max_ms", "wind_avg_ms", "rainfall_mm", "temp_max_c", "temp_avg_c",
                "ghi_sum_whm2"]
WEATHER_NOWCAST = TILE_WEATHER + ["upm"]
WEATHER_FORECAST = TILE_WEATHER

# Forest settings per job.
NOWCAST_FOREST = {"numTrees": 1000, "maxDepth": 5, "featureSubsetStrategy": "sqrt"}
FORECAST_FOREST = {"numTrees": 1000, "maxDepth": 10, "featureSubsetStrategy": "sqrt"}
MODEL_ID = "Random Forest (full)"

# Starts of the back-test windows (test days, and the wider days kept from training).
BACKTEST_STARTS = [dt.date(2022, 6, 16), dt.date(2022, 9, 1), dt.date(2023, 5, 1),
                   dt.date(2023, 8, 1)]
BACKTEST_DROP_STARTS = [dt.date(2022, 6, 9), dt.date(2022, 8, 25), dt.date(2023, 4, 24),
                        dt.date(2023, 7, 24)]
BACKTEST_DROP_DAYS = 21

# Field names of the hourly weather service and ours.
HOURLY_FIELDS = {
    "GlobalHorizontalIrradiance_WattsPerMeterSquared": "ghi",
    "DirectNormalIrradiance_WattsPerMeterSquared": "dni",
    "DiffuseHorizontalIrradiance_WattsPerMeterSquared": "dhi",
    "AmbientTemperature_DegreesC": "temp",
    "WindSpeed_MetersPerSecond": "wind",
    "LiquidPrecipitation_KilogramsPerMeterSquared": "rainfall_mm",
}

# Station columns and ours.
STATION_FIELDS = {
    "mess_datum": "date", "rsk": "rainfall_mm", "tmk": "temp_avg_c", "txk": "temp_max_c",
    "fx": "wind_max_ms", "fm": "wind_avg_ms",
}

# Columns of the experiment log.
EXPERIMENT_COLUMNS = ["experiment_id", "Mean 30cm", "Mean 60cm", "Mean 90cm", "Folds 30cm", "Folds 60cm",
                      "Folds 90cm", "model", "features", "hyper_parameters"]

# Settings of the compared regressors.
COMPARED_FOREST = {"numTrees": 300, "maxDepth": 5, "featureSubsetStrategy": "sqrt"}
COMPARED_BOOSTING = {"maxIter": 200, "stepSize": 0.01, "maxDepth": 5, "featureSubsetStrategy": "sqrt"}
