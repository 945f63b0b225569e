"""docketlake: a PySpark-native engine for versioned public documents."""
