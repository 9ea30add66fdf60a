"""The 15-minute metrics, alerts and daily slices on a stream."""
