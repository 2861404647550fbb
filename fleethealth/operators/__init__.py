"""Operators on telemetry: DataFrame in, DataFrame out, no action unless it says so."""
