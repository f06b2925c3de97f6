"""Plans: the five feed loads, the run DAG, and the driver stand-ins."""
