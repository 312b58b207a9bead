"""Writers: audit stamp, table replacement and append, file clustering."""
