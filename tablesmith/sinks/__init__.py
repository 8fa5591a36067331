"""Writers: file exports, versioned catalog tables, JDBC."""
