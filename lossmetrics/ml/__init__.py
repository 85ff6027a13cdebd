"""Models: severity classification, evaluation, forecasting and anomaly detection."""
