"""Tables, project files and directory listings as DataFrames."""
