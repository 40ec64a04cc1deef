"""A PySpark-native query layer: dialect front end, typed rows, text codec, file ingest."""
