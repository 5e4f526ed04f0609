from .text import PY_WHITESPACE, is_blank, py_strip  # noqa: F401
from .render import (  # noqa: F401
    CHAT_TEMPLATE,
    render_instruct,
    render_messages,
    render_instruct_text,
    render_messages_text,
    messages_md5,
)
