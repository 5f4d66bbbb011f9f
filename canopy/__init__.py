"""canopy: a Spark-native engine for urban tree sensing, weather and soil-moisture forecasting."""
