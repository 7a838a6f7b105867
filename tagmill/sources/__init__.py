"""Where data comes from: tables, query templates, files, JDBC."""
