"""Instants shared by fixtures and tests."""

import datetime as dt

T0 = dt.datetime(2024, 3, 1, 12, 0, 0)
