"""Elevation, GPS and gazetteer analytics on a multi-resolution tile grid.

Every public function takes and returns DataFrames or Columns and only
declares a plan; actions are left to the caller (sinks excepted).
"""
