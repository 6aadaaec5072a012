"""Where data comes from: message streams, raw lines, lake layers, typed tables."""
