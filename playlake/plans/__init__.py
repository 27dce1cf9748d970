"""Harness plans: each maps the driver's tables onto a playlake operator."""
