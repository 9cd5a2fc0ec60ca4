"""The text functions, written in the oracle's SQL."""

WS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def norm(x: str) -> str:
    return strip(f"coalesce({x}, '')")


def normalize(x: str) -> str:
    return f"nullif(trim(regexp_replace({x}, '{WS}+', ' ', 'g')), '')"


def fingerprint(review_id: str, author: str, body: str) -> str:
    return (
        f"case when nullif({review_id}, '') is not null then concat('id::', {review_id}) "
        f"else concat('ab::', sha1(concat(lower(coalesce({author}, '')), '|', "
        f"substring(lower(coalesce({body}, '')), 1, 200)))) end"
    )


def safe_component(x: str) -> str:
    kept = f"regexp_replace({norm(x)}, '[^A-Za-z0-9._-]+', '_', 'g')"
    return f"coalesce(nullif(trim({kept}, '._-'), ''), 'reviews')"


def slug(x: str) -> str:
    words = f"regexp_replace({norm(x)}, '{WS}+', '_', 'g')"
    kept = f"regexp_replace({words}, '[^A-Za-z0-9._-]+', '_', 'g')"
    return f"coalesce(nullif(lower(trim({kept}, '._-')), ''), 'empresa')"


def company_from_url(x: str) -> str:
    path = rf"regexp_extract({x}, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
    host = rf"regexp_extract({x}, '^[a-z]+://([^/?#]*)', 1)"
    named = f"regexp_extract({path}, '(?i)/review/([^/?#]+)', 1)"
    return safe_component(f"replace(coalesce(nullif({named}, ''), {host}), 'www.', '')")


def review_url(x: str) -> str:
    s = norm(x)
    return (
        f"case when {s} = '' then 'https://es.trustpilot.com/review/sending.es' "
        f"when regexp_matches({s}, '(?i)^https?://') then {s} "
        f"when strpos({s}, '.') = 0 and strpos({s}, '/') = 0 "
        f"then concat('https://es.trustpilot.com/review/www.', {s}, '.com') "
        f"else concat('https://es.trustpilot.com/review/', {s}) end"
    )


def not_empty(title: str, body: str, rating: str, author: str, date: str) -> str:
    return (
        f"(nullif({title}, '') is not null or nullif({body}, '') is not null "
        f"or coalesce({rating}, 0) <> 0 or nullif({author}, '') is not null "
        f"or nullif({date}, '') is not null)"
    )


def is_call(title: str, body: str) -> str:
    text = f"lower(concat_ws(' ', {title}, {body}))"
    phrases = ["write your review", "escribe tu reseña", "escribe tu review"]
    return "(" + " or ".join(f"contains({text}, '{p}')" for p in phrases) + ")"
