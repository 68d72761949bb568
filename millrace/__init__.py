"""millrace: tabular profiling, preparation and modelling expressed as Spark jobs."""

__version__ = "0.1.0"
