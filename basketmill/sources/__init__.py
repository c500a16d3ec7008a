"""Where invoice lines come from: files, the star-schema tables, or stored layers."""
