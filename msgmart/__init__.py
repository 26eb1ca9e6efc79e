"""Turn a lake of JSON messages into typed analytical tables with Spark."""
