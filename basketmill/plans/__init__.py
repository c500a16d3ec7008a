"""The analytic jobs: functions from a line source to a result frame."""
