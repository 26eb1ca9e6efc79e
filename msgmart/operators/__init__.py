"""DataFrame operators: payload access, arrays, latest version, increments."""
