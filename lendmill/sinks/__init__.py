"""Where data goes: layer frames and their writers."""
