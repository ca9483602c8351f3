"""The modelled tables: learning events, and industrial tag documents."""
