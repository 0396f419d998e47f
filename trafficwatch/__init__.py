"""trafficwatch: traffic-camera telemetry analytics on Spark.

Detections (speeding, red light, illegal parking) and camera statistics on
event time, usable unchanged on batch and streaming DataFrames, plus the
lookups and reports over the stored violations.
"""
__version__ = "0.1.0"
