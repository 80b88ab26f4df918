"""A PySpark-native analytics engine for typed, multi-tenant property graphs."""
