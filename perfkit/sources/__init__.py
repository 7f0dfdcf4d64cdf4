"""Sources and sinks: event logs, configuration files, the version registry."""
