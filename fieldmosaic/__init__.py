"""fieldmosaic: boundaries, colour-coded rasters and yearly statistics as Spark tables."""

__version__ = "0.1.0"
