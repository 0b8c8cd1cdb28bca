"""Layer transforms, quality rules, telemetry and table maintenance."""
