"""trackscene: vessel position x satellite scene fusion as Spark DataFrame operators."""

__version__ = "0.1.0"
