"""A PySpark-native engine for energy, weather, grid and rooftop analytics."""
