"""shroud: PySpark-native privacy engine (de-identify, delete, identity load, JSON redaction)."""

__version__ = "0.1.0"
