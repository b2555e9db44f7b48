"""Tables, streams and progress data in; tables, logs and exports out."""
