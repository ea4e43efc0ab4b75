"""Reports, checks and the layer build: functions over layer tables."""
